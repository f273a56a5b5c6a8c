import sys

from lexcurate.cli import main

sys.exit(main())
