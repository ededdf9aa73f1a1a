import sys

from galley.plans.run import main

sys.exit(main())
