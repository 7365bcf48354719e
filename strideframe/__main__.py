import sys

from strideframe.plans.cli import main

sys.exit(main())
