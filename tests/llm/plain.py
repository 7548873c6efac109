"""What the operator tests share besides fixtures."""

import re

SMALL = "/root/testdata/sf0.001"
WORDS = re.compile("[^\x20\x09-\x0d]+")
