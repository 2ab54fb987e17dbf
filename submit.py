"""Script for ``spark-submit submit.py COMMAND ...`` (executors run no Python and need no package)."""

from bankmetrics.__main__ import main

main()
