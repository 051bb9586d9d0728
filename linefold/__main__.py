"""``python -m linefold ...`` runs the command line (see ``linefold.cli``)."""

import sys

from linefold.cli import main

sys.exit(main())
