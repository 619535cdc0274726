"""Brute-force versions that the operators are held against."""

import hashlib
import json
import re
import zlib

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def documents(spark, texts, first=0):
    """Documents with the given texts and ids from ``first`` on."""
    rows = [(first + i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


def odd_documents(spark):
    """Nulls, empty and long texts, repeated rows, equal ids, and extra columns with clashing names."""
    rows = [
        (1, None), (2, ""), (3, "one two three"), (3, "one two three"), (4, "a" * 50_000), (5, "x y " * 5_000),
        (None, "no id here at all my friend"), (6, "été 漢字 \U0001f600"), (7, " \n\t "), (2**53 + 1, "far id"),
    ]
    rows = [(i, t, None, None, None, 7, "x", 3, 5, 1.5) for i, t in rows]
    extra = ", key int, row string, score int, range int, rank double"
    return spark.createDataFrame(rows, SCHEMA + extra)


def empty_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def lines(rows):
    return sorted(json.dumps(r.asDict(recursive=True), sort_keys=True, default=str) for r in rows)


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def remainder(key, divisor):
    return zlib.crc32(str(key).encode()) % divisor


def lowered(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")


def shingle_list(text):
    """Five-word shingles as the near-duplicate operators take them."""
    found = [w for w in re.split("[ \t\n\x0b\x0c\r]+", lowered(text)) if w]
    found += [""] * (5 - len(found))
    return [tuple(found[i : i + 5]) for i in range(len(found) - 4)]
