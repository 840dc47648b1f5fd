"""Benchmark decontamination by template canonicalisation.

Numbers, names and units become typed placeholders, so a question whose values were changed keeps its
template. Windows of template tokens are hashed on both sides and joined; matches that run along one
diagonal form a passage. Its slots are then compared: each benchmark value has to stand for one
document value throughout.

Every window of every item is indexed. A window with too few plain words says nothing as a template; it
is indexed with its values and has to match exactly. Items of fewer than ``SHORTEST`` tokens are matched
exactly as a whole, and those of fewer than ``ALONE`` only by a document that holds nothing else. A
passage counts if it covers ``MIN_RUN`` tokens or its whole item, and is either exact or consistent.

Items with one template throughout whose values repeat at the same places are a class: a document is
consistent with all of them or with none. Its template windows are indexed once, under its smallest
id, and ``item_classes`` tells the members: a template that many items and many documents share gives a
row per document and not one per pair.

The corpus is never shuffled: a bitmap of the benchmark's window hashes (at most ``MAX_BITS`` bits,
false hits do no harm) picks the windows that go into the join, and the join compares the whole
template besides the hash. Equal benchmark texts are one item, named by its smallest id.

Defined results: null and empty texts match nothing; repeated rows of an id are one document, and so are null
ids, whose texts are matched one by one; likewise the texts of an item's id; empty tables on either side give
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from feedmart.llm.common import landed, texts

WINDOW = 8
#: Items with fewer tokens are matched with their values, and with fewer still only as a whole document.
SHORTEST, ALONE = 5, 3
#: Tokens a passage needs, unless it is a whole item.
MIN_RUN = 10
#: Plain words a window needs to be matched as a template, or half of a shorter one.
PLAIN_IN_WINDOW = 4
#: The share of benchmark values that may stand for more than one document value.
MAX_UNSTEADY = 0.2
MAX_BITS = 1 << 27
#: Spellings a worker remembers before it starts anew.
REMEMBERED = 300_000

# Unit words, number words, and words that are no names though they start sentences.
UNITS = frozenset(
    "mm cm km kg mg ml meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard yards gram grams "
    "kilogram kilograms pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour hours day days "
    "week weeks month months year years dollar dollars cent cents euro euros percent degree degrees".split()
)
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen "
    "nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
COMMON = frozenset(
    "the a an in on at of to for and or but if when what which who whom whose where why how is are was were be do does did has "
    "have had it its he she they we you i this that these those there then than each every some all both many much there's "
    "find calculate given suppose let assume consider after before during by with from as not no yes so because while "
    "der die das ein eine und le la les un une et el los las y en de".split()
)
_EDGES = " .,;:!?\"'()[]{}<>«»“”‘’…–—-|*#"
_NUMBER = re.compile(r"[+-]?[$€£]?\d[\d.,:/]*(?:%|st|nd|rd|th)?[$€£]?")


def canonical(raw: str) -> tuple[str, bool]:
    """(template token, whether it is a slot); an empty token if nothing but punctuation is there."""
    core = raw.strip(_EDGES)
    low = core.lower()
    if not core:
        return "", False
    if _NUMBER.fullmatch(core) or low in NUMBER_WORDS:
        return "<num>", True
    if low in UNITS:
        return "<unit>", True
    if core[0].isupper() and (len(core) == 1 or core[1:].islower()) and low not in COMMON:
        return "<name>", True
    return low, False


class _Hashes(dict):
    """Raw word -> hash of its template token, or of its value if ``exact``; 0 for none. Filled as words are
    met."""

    def __init__(self, exact: bool = False):
        super().__init__()
        self._exact = exact

    def __missing__(self, raw: str) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        token = canonical(raw)[0]
        if token and self._exact:
            token = _value(raw)
        self[raw] = value = (xxh64_intdigest(token) | 1) if token else 0
        return value


def _value(raw: str) -> str:
    return raw.strip(_EDGES).lower()


def window_hashes(tokens: np.ndarray, size: int) -> np.ndarray:
    """A hash of each ``size`` tokens in a row."""
    n = len(tokens) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total, factor = np.zeros(n, np.uint64), 1
    for k in range(size):
        total += tokens[k : k + n] * np.uint64(factor)
        factor = factor * 0x9E3779B97F4A7C15 % 2**64
    total ^= total >> np.uint64(29)
    total *= np.uint64(0xBF58476D1CE4E5B9)
    return total ^ (total >> np.uint64(32))


def _tokens(text: str, hashes: _Hashes) -> tuple[list[str], np.ndarray]:
    raw = text.split()
    values = np.fromiter(map(hashes.__getitem__, raw), np.uint64, len(raw))
    if len(values) and not values.all():
        raw = [r for r, v in zip(raw, values) if v]
        values = values[values != 0]
    return raw, values


def _exact_hashes(raw: list[str], hashes: _Hashes, size: int) -> np.ndarray:
    """Window hashes by values, none of which is that of a template."""
    values = np.fromiter(map(hashes.__getitem__, raw), np.uint64, len(raw))
    return ~window_hashes(values, size)


def _window(raw: list[str], at: int, size: int, exact: bool) -> tuple[str, list[str]]:
    """Template and slot values of one window; with ``exact`` the values take the place of the slots."""
    parts = [(canonical(r), _value(r)) for r in raw[at : at + size]]
    if exact:
        return " ".join(value for _, value in parts), []
    return " ".join(token for (token, _), _ in parts), [value for (_, slot), value in parts if slot]


def _pattern(raw: list[str]) -> str:
    """The template, with each slot's value numbered as it first occurs."""
    numbers: dict[str, int] = {}
    tokens = ((canonical(r), _value(r)) for r in raw)
    return " ".join(f"{token} {numbers.setdefault(value, len(numbers))}" if slot else token for (token, slot), value in tokens)


_SHAPE = "size int, exact boolean, at int, hash long, template string, slots array<string>"
_KINDS = [pa.int32(), pa.bool_(), pa.int32(), pa.int64(), pa.string(), pa.list_(pa.string())]
_NAMES = ["size", "exact", "at", "hash", "template", "slots"]


def _batch(ids: list, rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    columns = [list(c) for c in zip(*rows)] if rows else [[] for _ in _KINDS]
    columns[3] = np.array(columns[3], np.uint64).view(np.int64)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, id_type), *(pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True))], ["id", *_NAMES]
    )


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """Every window of rows (id, text): id, the columns of a window, plain, n_tokens, whole (the digest of the
    item's template and of the places where its values repeat). A short item is one window. Windows with few
    plain words are exact."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, by_value = _Hashes(), _Hashes(exact=True)
        for batch in batches:
            for key, text in zip(batch.column(0), texts(batch.column(1))):
                raw, values = _tokens(text, hashes)
                size = min(window, len(raw))
                if not size:
                    continue
                exact_hashes, rows, plain = _exact_hashes(raw, by_value, size), [], []
                for at, h in enumerate(window_hashes(values, size)):
                    template, slots = _window(raw, at, size, False)
                    plain.append(size - len(slots))
                    if len(raw) >= SHORTEST and plain[-1] >= min(PLAIN_IN_WINDOW, (size + 1) // 2):
                        rows.append((size, False, at, h, template, slots))
                    else:
                        rows.append((size, True, at, exact_hashes[at], *_window(raw, at, size, True)))
                whole = hashlib.sha256(_pattern(raw).encode("utf-8", "surrogatepass")).hexdigest()
                out = _batch([key.as_py()] * len(rows), rows, batch.schema.field(0).type)
                out = out.append_column("n_tokens", pa.array([len(raw)] * len(rows), pa.int32()))
                yield out.append_column("whole", pa.array([whole] * len(rows), pa.string()))

    kind = items.schema["id"].dataType.simpleString()
    return items.select("id", "text").mapInArrow(run, f"id {kind}, {_SHAPE}, n_tokens int, whole string")


def item_classes(windows: DataFrame) -> DataFrame:
    """(id, class) of the items of ``item_windows``: items with one template whose values repeat at the same
    places, named by the smallest id."""
    named = windows.groupBy("whole").agg(F.min("id").alias("class"))
    return windows.select("id", "whole").distinct().join(named, "whole").select("id", "class")


def bitmap(windows: DataFrame) -> np.ndarray:
    """Bits by the lower digits of the hashes: 512 or more for each window, up to ``MAX_BITS``."""
    n = windows.count()
    bits = 1 << max(15, min(MAX_BITS.bit_length() - 1, (512 * n).bit_length()))
    place = F.col("hash").bitwiseAND(bits - 1)
    rows = (
        windows.groupBy(F.bitmap_bucket_number(place).alias("k"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("b"))
        .collect()
    )
    out = np.zeros(bits // 8 + 4096, np.uint8)
    for r in rows:  # 4 KB each, MAX_BITS / 32768 of them at most
        # bucket 1 holds the places 1 to 32768 as positions 0 to 32767; place 0 lies in bucket 0
        start = (r["k"] - 1) * 4096 if r["k"] else 0
        out[start : start + 4096] |= np.frombuffer(r["b"], np.uint8)
    return out


def _known(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64((len(bits) - 4096) * 8 - 1)
    at = np.where(place > 0, place - np.uint64(1), np.uint64(0)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def document_windows(docs: DataFrame, bits: np.ndarray, kinds: list[tuple[int, bool]]) -> DataFrame:
    """The windows of rows (id, text) that the bitmap may know, with the text's hash beside its id. ``kinds`` are
    sizes, and whether by value."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, by_value = _Hashes(), _Hashes(exact=True)
        for batch in batches:
            for key, text in zip(batch.column(0), texts(batch.column(1))):
                raw, values = _tokens(text, hashes)
                rows = []
                for size, exact in kinds:
                    if size < ALONE and len(raw) != size:
                        continue
                    found = _exact_hashes(raw, by_value, size) if exact else window_hashes(values, size)
                    rows += [
                        (size, exact, int(at), found[at], *_window(raw, at, size, exact)) for at in np.flatnonzero(_known(bits, found))
                    ]
                if rows:
                    whole = {"id": key.as_py(), "text": xxh64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1}
                    kind = pa.struct([("id", batch.schema.field(0).type), ("text", pa.int64())])
                    yield _batch([whole] * len(rows), rows, kind)

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text").mapInArrow(run, f"id struct<id:{kind},text:bigint>, {_SHAPE}")


def _hits(windows: DataFrame, known: DataFrame) -> DataFrame:
    pair = windows.alias("d").join(
        known.alias("i"), (F.col("d.hash") == F.col("i.hash")) & (F.col("d.template") == F.col("i.template"))
    )
    return pair.select(
        F.col("d.id").alias("id"),
        F.col("i.id").alias("item"),
        F.col("i.class").alias("class"),
        (F.col("d.at") - F.col("i.at")).alias("shift"),
        F.col("i.at").alias("at"),
        F.col("i.size").alias("size"),
        F.col("i.n_tokens").alias("n_tokens"),
        F.col("i.slots").alias("was"),
        F.col("d.slots").alias("now"),
    ).distinct()


def template_passages(hits: DataFrame) -> DataFrame:
    """Passages of template windows, with the share of values that stand for more than one."""
    keys = ["id", "item", "shift", "run"]
    runs = _runs(hits)
    values = (
        runs.select(*keys, F.explode(F.arrays_zip("was", "now")).alias("slot"))
        .groupBy(*keys, "slot.was")
        .agg(
            (F.min("slot.now") != F.max("slot.now")).alias("unsteady"),
            ((F.min("slot.now") != F.col("was")) | (F.max("slot.now") != F.col("was"))).alias("changed"),
        )
    )
    judged = values.groupBy(*keys).agg(F.avg(F.col("unsteady").cast("int")).alias("unsteady"), F.sum(F.col("changed").cast("int")).alias("changed"))
    spans = _spans(runs)
    same = [spans[k].eqNullSafe(judged[k]) for k in keys]
    steady = F.coalesce(judged["unsteady"], F.lit(0.0)) <= MAX_UNSTEADY
    return spans.join(judged, same, "left").filter(steady).select(
        *(spans[k] for k in _PASSAGE), F.coalesce("changed", F.lit(0)).alias("changed")
    )


def exact_passages(own: DataFrame, template: DataFrame, known: DataFrame) -> DataFrame:
    """Passages of windows that match with their values, of items that have such windows.

    Where a document meets an item's exact windows, the template windows of the item's class on the same
    diagonal belong to the passage if their values are the item's."""
    at = ["id", "class", "shift"]
    places = own.select(*at, "item").distinct()
    near = template.select(*[F.col(c).alias(f"t_{c}") for c in at], "at", "size", "n_tokens", "now")
    same = [places[c].eqNullSafe(near[f"t_{c}"]) for c in at]
    mine = known.filter(~F.col("exact")).select(F.col("id").alias("of"), F.col("at").alias("own_at"), F.col("slots").alias("own"))
    joined = places.join(near, same).join(mine, (F.col("of") == F.col("item")) & (F.col("own_at") == F.col("at")) & (F.col("own") == F.col("now")))
    kept = ["id", "item", "shift", "at", "size", "n_tokens"]
    runs = _runs(own.select(*kept).unionByName(joined.select(*kept)).distinct())
    return _spans(runs).select(*_PASSAGE, F.lit(0).cast("long").alias("changed"))


_PASSAGE = ["id", "item", "start", "tokens", "n_tokens"]


def _runs(hits: DataFrame) -> DataFrame:
    along = Window.partitionBy("id", "item", "shift").orderBy("at")
    # a window is as wide as its size, so a run goes on while the next one starts within the last
    gap = F.col("at") > F.lag("at").over(along) + F.col("size")
    return hits.withColumn("run", F.sum(F.coalesce(gap, F.lit(False)).cast("int")).over(along))


def _spans(runs: DataFrame) -> DataFrame:
    """Runs that are long enough; a run has as many windows as the item at most."""
    spans = runs.groupBy("id", "item", "shift", "run").agg(
        (F.min("at") + F.first("shift")).alias("start"),
        (F.max(F.col("at") + F.col("size")) - F.min("at")).alias("tokens"),
        F.max("n_tokens").alias("n_tokens"),
    )
    return spans.filter((F.col("tokens") >= MIN_RUN) | (F.col("tokens") >= F.col("n_tokens")))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Per document and item found in it: tokens of the longest passage, their share of the item, and
    how many of the item's values were changed (0 for a plain copy). An item that was found by its template
    alone stands for its class."""
    items = benchmark.groupBy(F.col(item_text_col).alias("text")).agg(F.min(item_id_col).alias("id"))
    # an id may be null, or name several texts: a text is told apart by both
    items = items.select(F.struct("id", F.md5("text").alias("text")).alias("id"), "text")
    every = landed(item_windows(items), "item-windows")
    known = landed(every.drop("whole").join(item_classes(every), "id"), "benchmark-windows")
    indexed = known.filter(F.col("exact") | (F.col("id") == F.col("class")))
    kinds = sorted((r["size"], r["exact"]) for r in indexed.select("size", "exact").distinct().collect())  # two per size to WINDOW
    bits = bitmap(indexed)
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    windows = landed(document_windows(named, bits, kinds), "document-windows")
    template = _hits(windows.filter(~F.col("exact")), indexed.filter(~F.col("exact")))
    found = template_passages(template)
    if any(exact for _, exact in kinds):
        own = _hits(windows.filter("exact"), indexed.filter("exact"))
        found = found.unionByName(exact_passages(own, template, known))
    best = F.max_by(F.struct("tokens", "start", "changed", "n_tokens"), F.struct("tokens", -F.col("changed"), -F.col("start"))).alias("best")
    return (
        found.groupBy(F.col("id.id").alias("id"), F.col("item.id").alias("item"))
        .agg(best, F.count_distinct("start").alias("n_passages"))
        .select(
            F.col("id").alias(id_col),
            F.col("item").alias(item_id_col),
            F.col("best.tokens").alias("n_tokens"),
            F.least(F.lit(1.0), F.col("best.tokens") / F.col("best.n_tokens")).alias("coverage"),
            F.col("best.changed").cast("long").alias("n_changed"),
            F.col("best.start").alias("start_token"),
            "n_passages",
        )
    )
