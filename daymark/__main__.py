import sys

from daymark.cli import main

sys.exit(main())
