"""Table functions."""

from __future__ import annotations

import re

from pyspark.sql.functions import udtf

_SPOTTED = re.compile(r"([^()]+)\(([0-9]+),([0-9]+)\),\(([0-9]+),([0-9]+)\)")


@udtf(returnType="text string, x1 int, y1 int, x2 int, y2 int")
class Spotted:
    """A row for each text with a box in a model's output, corners in order."""

    def eval(self, content: str):
        for found in _SPOTTED.finditer(content or ""):
            a, b, c, d = map(int, found.groups()[1:])
            yield found.group(1).strip(), min(a, c), min(b, d), max(a, c), max(b, d)
