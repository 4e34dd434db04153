"""The library's queries; importing this package registers them in the catalogue."""

from . import aggregates, files, relational, text  # noqa: F401
