"""Order MinHash fingerprints of documents, from built-in functions only.

A text's k-mers are its runs of ``K`` code points, white space as it is, each
numbered by how often the same k-mer came before it. All are hashed onto a
circle, a k-mer's first by the k-mer alone; slot j of the
fingerprint starts at the j-th of ``SLOTS`` even points and takes the ``PICK``
numbered k-mers that come first from there on, which are the minimal ones
under that slot's order of the hashes. They are put back into text order and
the tuple is hashed. Two texts agree in a slot if they share its minimal
k-mers and these stand in the same order, so the share of equal slots follows
edit distance rather than mere overlap.

Edge cases: a null text is empty; a text with fewer than ``K`` code points is
one k-mer; an empty text has a fingerprint of zeros; equal texts have equal
fingerprints. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netloom.functions.prefix import running_total
from netloom.session import materialize

K = 7
PICK = 2
SLOTS = 64
_BIN_BITS = 6  # SLOTS = 2 ** _BIN_BITS
#: Code points whose k-mers are taken from one short string, a power of 2.
_STRIDE = 32
#: Each _STRIDE code points, with the K - 1 that follow them.
_BLOCK = rf"(?s)(?=(.{{1,{_STRIDE + K - 1}}})).{{1,{_STRIDE}}}"
#: What a document's place in the order follows.
_KEYS = ["_known", "_id", "n_chars", "_hash"]
_POSITION = (1 << 31) - 1
#: 31 bits of a hash, above a bit of 0 and the 31 bits of a place.
_HIGH = _POSITION << 32
_BIN = 1 << (63 - _BIN_BITS)  # one bin of packed values
#: Sorted k-mers that are looked at by one compiled expression, a power of 2.
_SPAN = 16
#: No packed value, and no repeat's complement: the first place holds no repeat.
_NONE = -1


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _packed(hashed: Column, position: Column) -> Column:
    """31 bits of a hash above a position, in a long that is not negative."""
    return hashed.bitwiseAND(F.lit(_HIGH)).bitwiseOR(position.cast("long"))


def _hash(packed: Column) -> Column:
    return F.shiftright(packed, 32)


def _position(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(_POSITION))


def _none(kind: str) -> Column:
    """An empty array whose elements can't be null: Spark sorts such longs unboxed."""
    return F.slice(F.array(F.lit(0).cast(kind)), 1, 0)


def _range(n: Column) -> Column:
    """0 ... n - 1, and nothing for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(_none("int"))


def _runs(text: Column) -> Column:
    """Packed (k-mer, place) of a text, in text order. The text is cut into blocks
    first, as finding the i-th code point takes i steps from a string's start."""

    def of_block(block: Column, b: Column) -> Column:
        n = F.least(F.char_length(block) - (K - 1), F.lit(_STRIDE))
        base = b * _STRIDE
        places = F.when(n > 0, F.sequence(base, base + n - 1)).otherwise(_none("int"))
        return _let(base - 1, lambda before: F.transform(places, lambda i: _packed(F.xxhash64(F.substring(block, i - before, F.lit(K))), i)))

    return F.flatten(F.transform(_blocks(text), of_block))


def _blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_BLOCK), F.lit(1))


def _kmers(text: Column) -> Column:
    """The k-mers of ``text``, which is one k-mer if it has fewer code points than ``K``."""
    short = F.when(text != "", F.array(_packed(F.xxhash64(text), F.lit(0)))).otherwise(_none("long"))
    return F.when(F.char_length(text) >= K, _runs(text)).otherwise(short)


def _repeats(a: Column) -> Column:
    """Of sorted k-mers, those equal to the one before."""
    return F.filter(a, lambda x, i: x - F.get(a, i - 1) <= _POSITION)


def _nearest(a: Column) -> Column:
    """The first PICK of each bin, which are all that any slot can take."""
    rest = F.filter(a, lambda x, i: x.bitwiseXOR(F.get(a, i - PICK)) >= _BIN)
    return F.concat(F.slice(a, 1, PICK), rest)


def _bin(packed: Column) -> Column:
    return F.shiftright(packed, 63 - _BIN_BITS).cast("int")


def _renumbered(repeats: Column) -> Column:
    """Packed (numbered k-mer, place) of the repeats. Those of one k-mer stand
    together, in text order, so its number is the distance from the first of them."""
    starts = F.filter(_range(F.size(repeats)), lambda i: (i == 0) | (F.get(repeats, i) - F.get(repeats, i - 1) > _POSITION))

    def number(starts: Column) -> Column:
        def run(start: Column, j: Column) -> Column:
            end = F.coalesce(F.get(starts, j + 1), F.size(repeats)) - 1
            return F.transform(
                F.sequence(start, end),
                lambda i: _packed(F.xxhash64(_hash(F.get(repeats, i)), i - start + 1), _position(F.get(repeats, i))),
            )

        return F.flatten(F.transform(starts, run))

    return _let(starts, number)


def _slots(kept: Column) -> Column:
    # slot j starts at the first k-mer whose bin is j or later; after the last bin, at the first of all
    steps = F.transform(
        kept, lambda x, i: F.array_repeat(i, _bin(x) - F.when(i > 0, _bin(F.get(kept, i - 1))).otherwise(F.lit(-1)))
    )

    # place above hash, and as often as a slot that starts at the last one can need
    by_place = F.flatten(F.array_repeat(F.transform(kept, lambda x: F.shiftleft(_position(x), 32).bitwiseOR(_hash(x))), PICK))

    def slots(ring: Column) -> Column:
        def slot(start: Column) -> Column:
            picks = F.sort_array(F.array(*[F.get(ring, start + j) for j in range(PICK)]))
            hashed = _let(picks, lambda s: F.xxhash64(*[F.get(s, F.lit(j)).bitwiseAND(F.lit(_POSITION)) for j in range(PICK)]))
            return hashed.bitwiseAND(F.lit(_POSITION)).cast("int")

        return F.transform(starts, slot)

    starts = _let(F.flatten(steps), lambda s: F.concat(s, F.array_repeat(F.lit(0), F.lit(SLOTS) - F.size(s))))
    zeros = F.array_repeat(F.lit(0), SLOTS)
    return F.when(F.size(kept) > 0, _let(by_place, slots)).otherwise(zeros)


def _cut(rows: DataFrame, counts: list[Column]) -> DataFrame:
    """A row for each piece of the parts of a row, which have ``counts`` pieces:
    ``_at`` counts the pieces from 0 (null in the row that one without pieces
    leaves), ``_part`` and ``_place`` say which piece of which part it is."""
    ends = [sum(counts[1 : i + 1], counts[0]).alias(f"_end{i}") for i in range(len(counts))]
    rows = rows.select("*", *ends)
    rows = rows.select("*", F.explode_outer(_range(F.col(f"_end{len(counts) - 1}"))).alias("_at"))
    part, place = F.lit(0), F.col("_at")
    for i in range(len(counts) - 1):
        past = F.col("_at") >= F.col(f"_end{i}")
        part = F.when(past, i + 1).otherwise(part)
        place = F.when(past, F.col("_at") - F.col(f"_end{i}")).otherwise(place)
    return rows.select("*", part.alias("_part"), F.coalesce(place, F.lit(0)).alias("_place"))


def _gathered(pieces: DataFrame, row: list[str], names: list[str]) -> DataFrame:
    """One row again for each that was cut: ``_keep``, and the arrays ``_values`` of
    each part's pieces as one, named by ``names``."""
    keep = F.when(F.coalesce(F.col("_at"), F.lit(0)) == 0, F.col("_keep"))
    pieces = pieces.select(*row, keep.alias("_keep"), F.when(F.col("_at").isNotNull(), F.col("_part")).alias("_part"), "_values")
    # values read twice, or Spark would put them into the aggregate, which doesn't compile them
    some = F.size("_values") > 0
    lists = [F.collect_list(F.when((F.col("_part") == i) & some, F.col("_values"))).alias(name) for i, name in enumerate(names)]
    rows = pieces.groupBy(*row).agg(F.first("_keep", ignorenulls=True).alias("_keep"), *lists)
    return rows.select(*row, "_keep", *[F.flatten(name).alias(name) for name in names])


def _piece_of(parts: list[str], body: Callable[[str], Column]) -> Column:
    """``body`` of the part that a piece belongs to."""
    value = body(parts[0])
    for i, part in enumerate(parts[1:]):
        value = F.when(F.col("_part") == i + 1, body(part)).otherwise(value)
    return value


def _block_kmers(block: Column, number: Column) -> Column:
    """Packed (k-mer, place) of a text's block of this number, spelled out for each
    place, as Spark compiles that but no lambda. Places leave gaps after blocks that
    end early; only their order counts. A block that is a whole text of fewer code
    points than ``K`` is one k-mer."""
    n = F.least(F.char_length(block) - (K - 1), F.lit(_STRIDE))
    n = F.greatest(n, F.when(number == 0, 1).otherwise(0))
    packed = [_packed(F.xxhash64(F.substring(block, k + 1, K)), (number * _STRIDE).bitwiseOR(F.lit(k))) for k in range(_STRIDE)]
    return F.slice(F.array(*packed), F.lit(1), n)


def _marked(pieces: DataFrame, wholes: list[str]) -> DataFrame:
    """``pieces`` with ``_values``, of the ``_SPAN`` sorted k-mers of a piece: the
    repeats, as their complement, which is negative, and the others but for those
    that have ``PICK`` k-mers of their bin, none a repeat, right before them: no
    slot can take these. Steps are projections of their own, small enough to be compiled."""
    start = F.col("_place") * _SPAN
    pieces = pieces.select("*", _piece_of(wholes, F.col).alias("_whole"), start.alias("_from")).drop(*wholes)
    # _NONE is before the first and after the last
    index = {i: F.col("_from").bitwiseOR(F.lit(i)) if i > 0 else F.col("_from") + i for i in range(-PICK, _SPAN)}
    at = {i: F.coalesce(F.get("_whole", index[i]), F.lit(_NONE)).alias(f"_x{i + PICK}") for i in index}
    pieces = pieces.select("*", *at.values()).drop("_whole", "_from")
    x = {i: F.col(f"_x{i + PICK}") for i in at}

    def alike(i: int, j: int, bits: int) -> Column:
        return F.shiftrightunsigned(x[i].bitwiseXOR(x[j]), bits) == 0

    def marked(i: int) -> Column:
        far = alike(i, i - PICK, 63 - _BIN_BITS)
        for j in range(i - PICK + 1, i):
            far = far & ~alike(j, j - 1, 32)
        return F.when((x[i] < 0) | (far & ~alike(i, i - 1, 32)), F.lit(_NONE)).when(alike(i, i - 1, 32), F.bitwise_not(x[i])).otherwise(x[i])

    values = F.array_remove(F.array(*[marked(i) for i in range(_SPAN)]), F.lit(_NONE))
    return pieces.select("*", values.alias("_values")).drop(*[f"_x{i + PICK}" for i in at])


def fingerprints(
    df: DataFrame, texts: dict[str, Column], shared: Column | None = None, keep: list[str] | None = None, keys: list[str] | None = None
) -> DataFrame:
    """The columns ``keep`` of ``df`` (all, if not given) with a further column of
    ``SLOTS`` hashes of 31 bits for each name in ``texts``. All texts of a row
    start with the same ``shared`` code points, whose k-mers are taken once; a
    null text is empty.

    What there is to do for each code point is compiled, not done in lambdas: rows
    are cut into blocks of the texts, put together again, cut into spans of the
    sorted k-mers and put together again. That moves no row if ``df`` is
    partitioned by ``keys``, which may repeat and be null."""
    keep = df.columns if keep is None else keep
    n = F.lit(0) if shared is None else F.coalesce(F.when(shared >= K, shared).otherwise(0).cast("int"), F.lit(0))
    plain = [F.coalesce(text, F.lit("")) for text in texts.values()]
    rows = df.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys or [])],
        F.monotonically_increasing_id().alias("_row"),
        F.struct(*keep).alias("_keep"),
        n.alias("_n"),
        F.greatest(n - (K - 1), F.lit(0)).alias("_start"),
        *[text.alias(f"_text{i}") for i, text in enumerate(plain)],
    )
    row = [c for c in rows.columns if c.startswith("_key")] + ["_row"]
    parts = ["_head", *[f"_tail{i}" for i in range(len(plain))]]

    tails = [_blocks(F.substring(f"_text{i}", F.col("_start") + 1, F.length(f"_text{i}"))) for i in range(len(plain))]
    head = _blocks(F.substring("_text0", F.lit(1), F.col("_n")))
    rows = rows.select(*row, "_keep", *[x.alias(p) for x, p in zip([head, *tails], parts)])
    pieces = _cut(rows, [F.size(p) for p in parts]).select(
        *row, "_keep", "_at", "_part",
        F.coalesce(_piece_of(parts, lambda p: F.get(p, F.col("_place"))), F.lit("")).alias("_block"),
        # a text's blocks are those of the head and of its own tail
        (F.col("_place") + F.when(F.col("_part") == 0, 0).otherwise(F.size("_head"))).alias("_number"),
    )
    pieces = pieces.select("*", _block_kmers(F.col("_block"), F.col("_number")).alias("_values"))
    rows = _gathered(pieces, row, parts)

    wholes = [f"_sorted{i}" for i in range(len(plain))]
    rows = rows.select(*row, "_keep", *[F.sort_array(F.concat("_head", p)).alias(s) for p, s in zip(parts[1:], wholes)])
    pieces = _cut(rows, [F.ceil(F.size(s) / _SPAN).cast("int") for s in wholes])
    rows = _gathered(_marked(pieces, wholes), row, [f"_marked{i}" for i in range(len(plain))])

    # no step reuses the name of a column that it reads: Spark would read the new one inside lambdas
    steps = (
        ("_repeats", lambda i: F.sort_array(F.transform(F.filter(f"_marked{i}", lambda x: x < 0), F.bitwise_not))),
        ("_firsts", lambda i: F.filter(f"_marked{i}", lambda x: x >= 0)),
        ("_more", lambda i: _renumbered(F.col(f"_repeats{i}"))),
        ("_all", lambda i: F.sort_array(F.concat(f"_firsts{i}", f"_more{i}"))),
        ("_kept", lambda i: _nearest(F.col(f"_all{i}"))),
    )
    for step, build in steps:
        rows = rows.withColumns({f"{step}{i}": build(i) for i in range(len(plain))})
    return rows.select("_keep.*", *[_slots(F.col(f"_kept{i}")).alias(name) for i, name in enumerate(texts)])


def fingerprint(text: Column) -> Column:
    """The same as one expression, for a column of short texts."""

    def of_kmers(a: Column) -> Column:
        return _let(_repeats(a), lambda r: _let(F.sort_array(F.concat(F.array_except(a, r), _renumbered(r))), lambda k: _let(_nearest(k), _slots)))

    return _let(F.sort_array(_kmers(F.coalesce(text, F.lit("")))), of_kmers)


def as_string(slots: Column) -> Column:
    return F.array_join(F.transform(slots, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """How like two texts are, 0 to 1, from the share of equal slots. A slot
    needs ``PICK`` k-mers to agree, so the root of that degree estimates the
    share of k-mers that the texts have in common and in the same order."""
    same = F.size(F.filter(F.arrays_zip(a.alias("a"), b.alias("b")), lambda x: x["a"] == x["b"]))
    return F.pow(same.cast("double") / F.lit(float(SLOTS)), F.lit(1.0 / PICK))


def in_order(docs: DataFrame, part: int = 4) -> DataFrame:
    """Each document with ``head``, the start of the next one in doc_id order
    (after the last comes the first): as many code points as a ``part``-th of
    the document's own length, or all.

    Returns (doc_id, text, n_chars, place, n_places, head) and the columns ``_KEYS``,
    by which the rows are partitioned; ``place`` counts documents in order from 1. A null doc_id comes first; rows that share a
    doc_id go by length, then by hash of the text; rows equal in both are one
    document in the order and each of them is returned.

    Only ids, lengths and hashes are sorted. The texts cross the network once,
    to meet their place, and each head once more.
    """
    keys = _KEYS
    text = F.coalesce(F.col("text"), F.lit(""))
    # the id in two columns without nulls, so that plain equality joins it; both
    # uses below read these columns alone and so share one exchange of the texts
    rows = docs.select("doc_id", text.alias("text")).select(
        "text",
        F.col("doc_id").isNotNull().alias("_known"),
        F.coalesce(F.col("doc_id"), F.lit(0)).cast("long").alias("_id"),
        F.char_length("text").cast("long").alias("n_chars"),
        F.xxhash64("text").alias("_hash"),
    )
    places = running_total(rows.select(*keys).distinct().withColumn("_one", F.lit(1)), [], keys, "_one", "place")
    places = materialize(places.select(*keys, "place"), "omh_places")
    n = places.count()
    before = places.select(*[F.col(k).alias(f"_prev{k}") for k in keys], (F.col("place") % max(n, 1) + 1).alias("place"))
    linked = materialize(places.join(before, "place"), "omh_links")
    placed = rows.join(linked, keys)
    heads = (
        placed.select(
            *[F.col(f"_prev{k}").alias(k) for k in keys],
            F.substring("text", F.lit(1), F.floor(F.col("_prevn_chars") / part).cast("int")).alias("head"),
        )
        .groupBy(*keys)
        .agg(F.first("head").alias("head"))
    )
    doc_id = F.when(F.col("_known"), F.col("_id")).alias("doc_id")
    return placed.join(heads, keys).select(doc_id, "text", "n_chars", "place", F.lit(n).alias("n_places"), "head", "_known", "_id", "_hash")


def edited(text: Column, n_chars: Column, head: Column, part: int = 4) -> Column:
    """``text`` with its last ``part``-th replaced by ``head``."""
    return F.concat(F.substring(text, F.lit(1), (n_chars - F.floor(n_chars / part)).cast("int")), head)


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how like they
    are: (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next), fingerprints as arrays, the edited text as its SHA-256."""
    kept = F.col("n_chars") - F.floor(F.col("n_chars") / 4)
    rows = in_order(docs).withColumn("edited", edited(F.col("text"), F.col("n_chars"), F.col("head")))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256))
    texts = {"fingerprint": F.col("text"), "edited_fingerprint": F.col("edited")}
    prints = fingerprints(rows, texts, kept, keep=["doc_id", "n_chars", "place", "n_places", "edited_sha256"], keys=_KEYS)
    prints = materialize(prints, "omh_prints")  # computed once, for both joins
    nexts = prints.dropDuplicates(["place"]).select(
        F.when(F.col("place") > 1, F.col("place") - 1).otherwise(F.col("n_places")).alias("place"),
        F.col("fingerprint").alias("_next"),
    )
    return prints.join(nexts, "place").select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )
