"""The registered query of each operator and the DuckDB SQL of those that SQL can express."""

from tillwise.llm.extraction import op12_html_extraction
from tillwise.llm.fingerprints import op10_fingerprints
from tillwise.llm.mixing import OP2_SQL, op2_mixing
from tillwise.llm.packing import op8_packing
from tillwise.llm.privacy import op6_privacy
from tillwise.llm.quality import op4_quality
from tillwise.llm.repair import op13_conversation_repair
from tillwise.llm.resampling import op11_importance_resampling
from tillwise.llm.sharding import op7_sharding
from tillwise.llm.simhash import op5_simhash
from tillwise.llm.substring import OP1_SQL, op1_substring_dedup
from tillwise.llm.token_files import op3_token_files
from tillwise.llm.topk import OP9_SQL, op9_exact_topk

QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_mixing": op2_mixing,
    "op3_token_files": op3_token_files,
    "op4_quality": op4_quality,
    "op5_simhash": op5_simhash,
    "op6_privacy": op6_privacy,
    "op7_sharding": op7_sharding,
    "op8_packing": op8_packing,
    "op9_exact_topk": op9_exact_topk,
    "op10_fingerprints": op10_fingerprints,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_html_extraction": op12_html_extraction,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLES = {
    "op1_substring_dedup": OP1_SQL,
    "op2_mixing": OP2_SQL,
    "op9_exact_topk": OP9_SQL,
}
