"""spark-submit run_job.py <job> --topic ..."""

from tallystream.streaming.cli import main

if __name__ == "__main__":
    main()
