"""spark-submit entry of the batch jobs."""

import sys

from swipeline.plans.jobs import main

if __name__ == "__main__":
    sys.exit(main())
