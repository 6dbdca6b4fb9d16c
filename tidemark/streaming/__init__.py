from tidemark.streaming.landing import start_landing

__all__ = ["start_landing"]
