"""Launcher for spark-submit, which runs a file as a script:

    spark-submit --py-files tillstar.zip tillstar_submit.py run --raw ... --out ...
"""

import sys

from tillstar.__main__ import main

if __name__ == "__main__":
    sys.exit(main())
