"""Where the test tables lie. Kept out of conftest, whose module name is not unique."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
