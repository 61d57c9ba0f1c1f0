"""Array, map and JSON functions as Column builders. Positions count from 1."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.lazy import mapped
from lexmill.functions.strings import col


def insert(xs, value: Column, at: int | None = None) -> Column:
    return F.array_append(col(xs), value) if at is None else F.array_insert(col(xs), at, value)


def remove(xs, at: int | None = None) -> Column:
    xs = col(xs)
    n = F.size(xs)
    place = n if at is None else F.lit(at)
    return F.when((place >= 1) & (place <= n), F.concat(F.slice(xs, F.lit(1), F.greatest(place - 1, F.lit(0))), F.slice(xs, place + 1, n))).otherwise(xs)


def concat_range(xs, sep: str = "", first: int = 1, last: int | None = None) -> Column:
    xs = col(xs)
    end = F.size(xs) if last is None else F.least(F.size(xs), F.lit(last))
    return F.array_join(F.slice(xs, F.lit(first), F.greatest(end - first + 1, F.lit(0))), sep)


def sort(xs, descending: bool = False) -> Column:
    return F.sort_array(col(xs), not descending)


def sort_by(xs, key) -> Column:
    """Sorted by a key; equal keys keep their order."""
    placed = F.transform(col(xs), lambda x, i: F.struct(key(x).alias("k"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(placed), lambda p: p["x"])


def max_key(m) -> Column:
    """The greatest positive number among the keys, else 0."""
    return F.coalesce(F.array_max(F.filter(F.map_keys(col(m)), lambda k: k > 0)), F.lit(0))


def length(xs):
    return F.size(col(xs))


def until_null(xs) -> Column:
    """The elements before the first null."""
    xs = col(xs)
    stop = F.array_position(F.transform(xs, lambda x: x.isNull()), F.lit(True)).cast("int")
    return F.slice(xs, F.lit(1), F.when(stop > 0, stop - 1).otherwise(F.size(xs)))


def select(xs, n: int) -> Column:
    """Elements from n on; a negative n counts from the end."""
    xs = col(xs)
    if n < 0:
        return F.slice(xs, F.greatest(F.size(xs) + n + 1, F.lit(1)), F.lit(-n))
    return F.slice(xs, F.lit(n), F.size(xs))


def next_key(m, key: Column) -> Column:
    """The key behind ``key`` in the order of the map; null after the last one."""
    keys = F.map_keys(col(m))
    at = F.array_position(keys, key).cast("int")
    return F.when(at < F.size(keys), F.try_element_at(keys, at + 1))


def set_key(m, key: Column, value: Column) -> Column:
    m = col(m)
    return F.map_concat(F.map_filter(m, lambda k, _: k != key), F.create_map(key, value))


def _drop_trailing_commas(text: str) -> str:
    """Commas before a closing bracket go, but not inside strings."""
    return re.sub(r'"(?:[^"\\]|\\.)*"|,(?=\s*[\]}])', lambda m: m[0] if m[0][0] == '"' else "", text)


def json_decode(x, repair: bool = False) -> Column:
    """A VARIANT, null for text that is no JSON; trailing commas can be forgiven."""
    return F.try_parse_json(mapped(_drop_trailing_commas, "string", col(x)) if repair else col(x))


def json_encode(x):
    return F.to_json(col(x))


def _sequences(value):
    if isinstance(value, dict):
        done = {k: _sequences(v) for k, v in value.items()}
        if done and all(str(i) in done for i in range(1, len(done) + 1)):
            return [done[str(i)] for i in range(1, len(done) + 1)]
        return done
    return [_sequences(v) for v in value] if isinstance(value, list) else value


def _with_sequences(text: str) -> str | None:
    try:
        return json.dumps(_sequences(json.loads(text)), ensure_ascii=False, separators=(",", ":"))
    except ValueError:
        return None


def json_sequences(x) -> Column:
    """Objects with the keys 1..n as lists; null for text that is no JSON."""
    return mapped(_with_sequences, "string", col(x))


def localized(json_text, languages: list[str]) -> Column:
    """The value of the first language of a chain that an object has; plain JSON text stays."""
    x = col(json_text)
    picks = [F.get_json_object(x, f"$['{code}']") for code in languages]
    return F.when(F.ltrim(x).startswith("{"), F.coalesce(*picks)).otherwise(F.from_json(F.concat(F.lit("["), x, F.lit("]")), "array<string>")[0])


def pairs(m) -> Column:
    """The (key, value) entries of a map in the order of the keys."""
    return F.array_sort(F.map_entries(col(m)))


def get_key(m, key: Column) -> Column:
    """The value of a key, null for none."""
    return F.try_element_at(col(m), key)


def unpack(xs, first: int = 1, last: int | None = None) -> Column:
    """(place, value) of the values from first to last, to be exploded; places without a value are null."""
    xs = col(xs)
    stop = F.size(xs) if last is None else F.lit(last)
    places = F.when(stop >= first, F.sequence(F.lit(first), stop)).otherwise(F.array().cast("array<int>"))
    return F.transform(places, lambda i: F.struct(i.alias("place"), F.get(xs, i - 1).alias("value")))


def dump(x) -> Column:
    """A nested value as text in a stable order of keys."""
    return F.to_json(col(x), {"sortKeys": "true", "ignoreNullFields": "false"})
