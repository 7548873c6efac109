"""Steps that must not grow faster than their input: what is shuffled, and how often texts are read."""

from __future__ import annotations

import re

from builders import merchants, transactions
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tillwise import constants as k
from tillwise.functions import marks
from tillwise.operators import features, lexicon, models, sentiment, text_model
from tillwise.plans import batch, registry
from tillwise.plans.batch import BatchConfig, run_batch
from tillwise.sources import derived, readers, sinks
from tillwise.sources.derived import DomainTables, StarTables

ROWS = "id INT, text STRING, mood STRING, topic STRING"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def feedback(spark):
    said = [
        ("good fast good", "up", "a"), ("good slow", "up", "b"), ("bad slow", "down", "a"), ("bad fast", "down", None),
        ("good plain", None, "b"), (None, "up", "a"), ("", None, None), ("bad good", "flat", "c"),
    ]
    return spark.createDataFrame([(i, *row) for i, row in enumerate(said * 2)], ROWS)


def test_lexicons_of_several_labels_cut_texts_once(spark):
    rows = feedback(spark)
    labels = {"mood": ["up", "down"], "topic": None}
    every = lexicon.learn_lexicons(rows, labels, least_texts=1)
    alone = [lexicon.learn_lexicon(rows, label, kinds=kinds, least_texts=1) for label, kinds in labels.items()]
    expected = sorted(tuple(r) for part in alone for r in part.collect())
    assert expected and sorted(tuple(r) for r in every.collect()) == expected
    assert plan(every).split("== Initial Plan ==")[-1].count("Generate explode") == 1
    # A named column would be computed twice, for the generator and for a filter inferred from it.
    assert "size(array_distinct" not in plan(every)


def test_only_known_terms_are_folded_and_shuffled(spark, monkeypatch):
    rows = feedback(spark)
    known = text_model.vocabulary(rows, vocab_size=3)
    every, met = text_model.term_counts(rows), text_model.term_counts(rows, known=known)
    terms = [r.term for r in known.collect()]
    expected = sorted(map(str, every.where(F.col("term").isin(terms)).collect()))
    assert sorted(map(str, met.collect())) == expected and met.count() < every.count()
    # The terms of a text are filtered below the fold and its shuffle.
    text = plan(met)
    assert re.search(r"Exchange hashpartitioning\(_key#\d+, term#\d+.*filter\([^\n]* IN(SET)? ", text, re.S), text
    monkeypatch.setattr(text_model, "MOST_LISTED", 1)
    joined = text_model.term_counts(rows, known=known)
    assert sorted(map(str, joined.collect())) == expected and "LeftSemi" in plan(joined)
    assert text_model.term_counts(rows, known=known.limit(0)).count() == 0


def test_shown_texts_are_shortened_before_the_join(spark):
    rows = spark.createDataFrame([(i, f"good {'x' * 300}", None, None) for i in range(4)], ROWS)
    shown = sentiment.batch_sentiment(rows, method="rule", lexicon=lexicon.fixed_lexicon(spark))
    joined = shown._jdf.queryExecution().optimizedPlan().toString()
    left = next(line for line in joined.splitlines()[1:] if re.search(r"[+:]- Project|- Join|LogicalRDD", line) and "_shown" in line)
    assert not re.search(r"[\[ ]text#\d+[,\]]", left), joined
    assert {len(r.text) for r in shown.collect()} == {103} and shown.columns[0] == "id"


def test_texts_of_one_row_group_are_dealt(spark, tmp_path, monkeypatch):
    rows = spark.range(200).select(
        F.when(F.col("id") % 50 != 0, F.col("id")).alias("doc_id"), F.repeat(F.lit("words "), 50).alias("text"), F.col("id").alias("n_chars")
    )
    rows.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    whole = StarTables(spark, str(tmp_path))
    filled = lambda df: df.groupBy(F.spark_partition_id()).count().count()
    assert filled(whole.texts("documents")) == 1  # a small file is read as it is
    monkeypatch.setattr(derived, "TEXT_FILE_BYTES", 400)
    StarTables._dealt.clear()
    dealt = whole.texts("documents")
    assert filled(dealt) > 1
    assert sorted(map(str, dealt.collect())) == sorted(map(str, rows.collect()))
    again = StarTables(spark, str(tmp_path)).texts("documents")
    assert again.inputFiles() == dealt.inputFiles()
    rows.limit(20).coalesce(1).write.mode("append").parquet(f"{tmp_path}/documents.parquet")
    assert whole.texts("documents").count() == 220
    StarTables._dealt.clear()


def test_facts_are_shuffled_by_month_as_narrow_rows(spark, sf_dir):
    tables = DomainTables(spark, sf_dir)
    facts = tables.facts_by_month()
    lines = plan(facts).splitlines()
    by_month = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(year" in line)
    assert "transaction_id" in "".join(lines[:by_month]) and "transaction_id" not in "".join(lines[by_month:])
    assert not any(wide in "".join(lines[by_month:]) for wide in ("merchant_id", "user_id", "total_fee_usd", "net_amount"))
    stored = tables["transactions"]
    assert facts.select(*stored.columns).exceptAll(stored).count() == 0 and facts.count() == stored.count()


def test_order_lines_are_numbers_and_shuffled_once(spark, sf_dir, monkeypatch):
    # Tables that the planner would not broadcast by itself.
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    star = StarTables(spark, sf_dir)
    names = derived.countries(star)
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sent = derived.order_lines(star, names)
        assert {f.dataType.typeName() for f in sent.schema.fields} <= {"long", "integer", "double", "date"}
        assert "hashpartitioning(supplier" not in plan(sent)
        monkeypatch.setattr(derived, "MOST_SENT", 0)
        joined = derived.order_lines(star, names)
        assert "hashpartitioning(supplier" in plan(joined)
        rows, others = (derived.to_transactions(x, names) for x in (sent, joined))
        assert rows.count() > 0 and rows.exceptAll(others).count() == 0 and others.exceptAll(rows).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_months_are_split_by_their_rows(spark, sf_dir, monkeypatch):
    tables = DomainTables(spark, sf_dir)
    rows = tables.star["lineitem"].count()
    assert len(tables._by_month(rows)) == 3
    monkeypatch.setattr(derived, "FILE_ROWS", 20)
    monkeypatch.setattr(derived, "TASK_ROWS", 300)
    assert tables._by_month(rows)[0] == -(-rows // 300) > 8
    facts = tables.facts_by_month()
    # A month of many rows goes to several tasks, each with the rows of one file.
    files = facts.select("year", "month", F.spark_partition_id().alias("task")).distinct().groupBy("year", "month").agg(F.count("*").alias("n"))
    assert files.agg(F.max("n")).first()[0] > 1
    assert facts.count() == tables.derive("transactions").count()


def test_joins_of_the_landing_follow_the_rows(spark, sf_dir, tmp_path, monkeypatch):
    name, planned = "spark.sql.shuffle.partitions", []
    before = spark.conf.get(name)
    tables = DomainTables(spark, sf_dir)
    monkeypatch.setattr(derived, "TASK_ROWS", 300)
    write = DataFrameWriter.parquet

    def noted(self, path, *args, **kwargs):
        planned.append(int(spark.conf.get(name)))
        write(self, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    tables._write("transactions", f"{tmp_path}/facts")
    assert planned == [-(-tables.star["lineitem"].count() // 300)] and planned[0] > int(before)
    assert spark.conf.get(name) == before
    facts = spark.read.parquet(f"{tmp_path}/facts").select(*tables["transactions"].columns)
    assert facts.count() == tables["transactions"].count() and facts.exceptAll(tables["transactions"]).isEmpty()


def test_texts_are_not_shuffled_for_their_labels(spark, tmp_path, sf_dir, monkeypatch):
    said = [(1, "a b", "s1"), (1, "c", "s2"), (2, None, "s3"), (None, "d", None), (4, "e", "s0")]
    rows = spark.createDataFrame([(*r, 3) for r in said], "doc_id LONG, text STRING, source STRING, n_chars LONG")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    marks = [(1, 1, 0), (1, 0, 0), (2, 1, 1), (None, 1, 0)]
    spark.createDataFrame(marks, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    spark.range(3).select(F.col("id").alias("s_suppkey")).write.parquet(f"{tmp_path}/supplier.parquet")
    star = StarTables(spark, str(tmp_path))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        sent = derived.derive_feedback(star)
        assert "hashpartitioning(doc_id" not in plan(sent)
        monkeypatch.setattr(derived, "MOST_SENT", 0)
        joined = derived.derive_feedback(star)
        assert "hashpartitioning(doc_id" in plan(joined)
        assert sent.count() == 7 and sorted(map(str, sent.collect())) == sorted(map(str, joined.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_words_fold_by_narrow_keys(spark):
    rows = feedback(spark)
    learnt = lexicon.learn_lexicons(rows, {"mood": ["up", "down"], "topic": None}, least_texts=1)
    # Between the generator of words and their fold no label is wrapped.
    made = plan(learnt).split("Generate explode")[0].rsplit("HashAggregate", 1)[1]
    assert "_label0" in made and "struct(" not in made, made
    assert {r.kind for r in learnt.collect()} == {"up", "down", "a", "b", "c"}
    assert {r.kind for r in lexicon.learn_lexicon(rows, "mood", kinds=["none"], least_texts=1).collect()} == set()


def labelled(spark):
    names = {c: F.lit("a") for c in k.MODEL_CATEGORICALS}
    return spark.range(0, 100, numPartitions=8).select(
        F.concat(F.lit("M"), F.col("id")).alias("merchant_id"), F.col("id").alias("x"), (F.col("id") % 2).alias("y")
    ).withColumns(names)


def test_fits_run_in_tasks_of_rows(spark, monkeypatch):
    monkeypatch.setattr(models, "FIT_ROWS", 25)
    rows = models._prepare(labelled(spark), ["x"], "y", models.BoostingParams())
    assert rows.select(F.spark_partition_id()).distinct().count() == 4 and rows.count() == 100


def test_splits_are_made_from_cut_rows(spark, monkeypatch):
    plans, split = [], models.stratified

    def noted(rows, *args):
        plans.append(plan(rows))
        return split(rows, *args)

    monkeypatch.setattr(models, "stratified", noted)
    rows = models._prepare(labelled(spark), ["x"], "y", models.BoostingParams(), stratify=True)
    assert rows.count() == 100 and rows.where("is_test").count() == 20
    assert len(plans) == 2 and "Range" not in plans[0]


def test_scores_and_status_share_the_requests(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"  # a fit needs more merchants than sf0.001 has
    quick = models.BoostingParams(trees=2, depth=2, cross_validate=False)
    monkeypatch.setattr(registry, "pricing_model", lambda t: models.fit_pricing(t["merchants"], t["transactions"], quick))
    scored = registry.QUERIES["score_pricing_model"](spark, folder)
    assert "landed/transactions" not in plan(scored)
    merchants = DomainTables(spark, folder)["merchants"]
    assert 0 < scored.count() <= merchants.count()


def ran(df) -> str:
    """The plan as it ran."""
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def shuffle_files(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().iterator()
    names = set()
    while files.hasNext():
        names.add(files.next().getName())
    return {n for n in names if n.startswith("shuffle_")}


def test_ingest_shuffles_hashes_and_only_likely_copies(spark, tmp_path, monkeypatch):
    rows = [(i % 70 or None, "ab"[i % 2], i % 3 or None) for i in range(900)] + [(i, "x" * 50, None) for i in range(900, 1500)]
    spark.createDataFrame(rows, "a INT, text STRING, c INT").write.parquet(str(tmp_path / "rows"))
    table = spark.read.parquet(str(tmp_path / "rows"))
    single = readers.ingest({"t": table.where("a >= 900")})["t"]
    shuffles = [x for x in ran(single).split("\n") if " Exchange" in x]
    assert single.count() == 600 and all("text" not in x for x in shuffles)
    for bits in (marks.MARKS, 256, 64):  # with few bits, most rows share a mark with a copy
        monkeypatch.setattr(marks, "MARKS", bits)
        got = [tuple(r) for r in readers.ingest({"t": table})["t"].collect()]
        assert len(got) == len(set(rows)) and set(got) == set(rows)


def test_batch_steps_leave_no_shuffles_on_disk(spark, tmp_path, monkeypatch):
    raw = {
        "merchants": merchants(spark, [{"merchant_id": f"M{i % 4}"} for i in range(5)]),
        "transactions": transactions(spark, [{"merchant_id": f"M{i % 4}"} for i in range(40)]),
    }
    for name, df in raw.items():
        sinks.write_table(df, str(tmp_path / f"raw/{name}.parquet"))
    before, left = shuffle_files(spark), {}

    def noting(df, path, *args):
        rows = sinks.write_table(df, path, *args)
        left[path] = shuffle_files(spark) - before
        return rows

    monkeypatch.setattr(batch, "write_table", noting)
    config = BatchConfig(str(tmp_path / "raw"), str(tmp_path / "out"), input_format="parquet", batch_date="2001-08-01")
    data = run_batch(spark, config)
    assert len(left) == 6 and not set().union(*left.values()) and not shuffle_files(spark) - before
    assert data["merchants"].count() == 4 and data["daily_summary"].count() == 1
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_amounts_are_shuffled_once_for_the_median(spark):
    amounts = {"M1": [3, 1, 2], "M2": [5, 5, 1, 7], "M3": [None], "M4": []}
    facts = [
        {"merchant_id": m, "amount_usd": a, "hour": 5 + i % 2, "is_cross_border": a == 5}
        for m, of in (*amounts.items(), (None, [9])) for i, a in enumerate(of)
    ]
    found = features.pricing_features(
        merchants(spark, [{"merchant_id": m} for m in amounts]), transactions(spark, facts)
    )
    assert len(re.findall(r"- Exchange hashpartitioning\(merchant_id#\d+, amount_usd#\d+", ran(found))) == 1
    got = {r.merchant_id: (r.avg_amount, r.amount_std, r.median_amount, r.cross_border_ratio, r.peak_hour) for r in found.collect()}
    assert got["M1"] == (2.0, 1.0, 2.0, 0.0, 5) and got["M3"] == (0.0, 0.0, 0.0, 0.0, 5) and got["M4"] == (0.0,) * 4 + (0,)
    assert got["M2"][0] == 4.5 and abs(got["M2"][1] - 19 ** 0.5 / 3 ** 0.5) < 1e-12 and got["M2"][2:] == (5.0, 0.5, 5)
