import sys

from lakecart.cli import main

sys.exit(main())
