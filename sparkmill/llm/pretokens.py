"""Pre-tokens of byte-level BPE by the public pattern, and the units inside which prefixes of a text change them."""

from __future__ import annotations

import regex

_SHORT = r"'(?:[stmd]|re|ve|ll)"
#: The public pattern with its contractions factored; the alternatives keep their order.
PRETOKEN = regex.compile(_SHORT + r"| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: White space together with the one chunk after it.
UNIT = regex.compile(r"\s* (?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s*" + _SHORT + r"|\s*(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+")
