"""Entry script for ``spark-submit``; see README for the settings file."""

from spendscore.__main__ import main

main()
