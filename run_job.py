"""Script for spark-submit: ``spark-submit --py-files terrane.zip run_job.py --root ... <job>``."""

from terrane.__main__ import main

if __name__ == "__main__":
    main()
