"""spark-submit entry of the streaming application."""

from swipeline.streaming.app import main

if __name__ == "__main__":
    main()
