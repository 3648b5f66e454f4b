"""Where the tables of the tests lie."""

import os

DATA = os.environ.get("QUIRE_DATA", "/root/testdata")
