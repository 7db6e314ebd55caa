"""Entry point for spark-submit; `--help` lists the jobs."""

from sediment.main import main

if __name__ == "__main__":
    main()
