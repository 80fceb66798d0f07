"""``python -m idloom``."""

import sys

from idloom.cli import main

sys.exit(main())
