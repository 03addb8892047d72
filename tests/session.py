"""The session of the tests."""

from loadlens.sources.session import local_session

__all__ = ["local_session"]
