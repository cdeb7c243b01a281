"""Where the repository and the smallest driver tables are, for tests that need it at import."""

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SMOKE = "/root/testdata/sf0.001"
