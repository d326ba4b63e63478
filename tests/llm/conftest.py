from .corpus import docs, none  # noqa: F401
