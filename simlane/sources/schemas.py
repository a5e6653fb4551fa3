"""StructTypes of the recommendation domain, built from a schema listing.

The listing is a Markdown table with rows '| Name | ... | 1:field TYPE; 2:field TYPE |' and, for enums,
'| *enum* NAME | ... | A=1, B=2 |'; types are Spark's, other names in the listing, ARRAY<T>, ARRAY(set)<T> and MAP<K,V>."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import types as T

SAME_VIDEO_REQUEST = T.StructType([T.StructField(n, T.StringType()) for n in ("vid", "title", "video_url")])
SAME_VIDEO_RESPONSE = T.StructType([T.StructField("has_same_video", T.BooleanType()), T.StructField("same_video", T.StringType()), T.StructField("err_code", T.IntegerType())])
_PLAIN = {"STRING": T.StringType(), "INT": T.IntegerType(), "BIGINT": T.LongType(), "SMALLINT": T.ShortType(), "DOUBLE": T.DoubleType(), "BOOLEAN": T.BooleanType()}


class Listing:
    """The structs and enums of a listing file; structs[name] is a StructType whose fields carry their ids as metadata."""

    def __init__(self, path: str | Path):
        self.fields: dict[str, list[tuple[int, str, str]]] = {}
        self.enums: dict[str, dict[str, int]] = {}
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            cells = [c.strip() for c in line.strip().strip("|").split("|")]
            if len(cells) != 3:
                continue
            if cells[0].startswith("*enum* "):
                self.enums[cells[0][7:]] = {k: int(v) for k, v in re.findall(r"(\w+)=(-?\d+)", cells[2])}
            elif re.fullmatch(r"\w+", cells[0]) and re.match(r"\d+:\w+ \S", cells[2]):
                self.fields[cells[0]] = [(int(i), n, t) for i, n, t in re.findall(r"(\d+):(\w+) ([^;]+)", cells[2])]
        self.structs = {name: self._struct(name) for name in self.fields}

    def _struct(self, name: str) -> T.StructType:
        return T.StructType([T.StructField(n, self._type(t.strip()), True, {"id": i}) for i, n, t in self.fields[name]])

    def _type(self, text: str) -> T.DataType:
        if text in _PLAIN:
            return _PLAIN[text]
        if m := re.fullmatch(r"ARRAY(?:\(set\))?<(.+)>", text):
            return T.ArrayType(self._type(m[1]))
        if m := re.fullmatch(r"MAP<(\w+),(.+)>", text):
            return T.MapType(self._type(m[1]), self._type(m[2]))
        return self._struct(text)
