"""spark-submit entry point: ``spark-submit --py-files tributary.zip scripts/run_pipelines.py run pipelines/``."""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tributary.__main__ import main  # noqa: E402

if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
