import sys

from kinweld.plans.cli import main

sys.exit(main())
