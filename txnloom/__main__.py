import sys

from .plans.jobs import main

sys.exit(main())
