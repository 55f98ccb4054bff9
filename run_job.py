"""Launcher for spark-submit: ``spark-submit --py-files incentiva.zip run_job.py --parquet-root ... --out ...``."""

from incentiva.plans.cli import main

if __name__ == "__main__":
    print(main())
