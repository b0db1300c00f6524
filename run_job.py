"""Entry script for spark-submit."""

from georisk.jobs import main

if __name__ == "__main__":
    main()
