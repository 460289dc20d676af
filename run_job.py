"""spark-submit entry: spark-submit --py-files millrace.zip run_job.py <job> ..."""

from millrace.cli import main

main()
