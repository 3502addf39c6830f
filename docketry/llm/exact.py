"""Exact dedup: every text has an owner in a Patricia trie.

Pass one reads the texts, deletes their white space and inserts what is left, as whole byte strings,
into a trie a task. A terminal is a class: it has the number of its rows and its owner, the row of
the most original code points, then of the smallest id. A trie that holds more than ``trie_bytes``
spills its largest subtree: the classes below it go out and their strings are forgotten, so a later
copy begins another class. So a copy group moves at most one string a task and spill, however many
rows it has; each row keeps the number of its class alone.

Pass two deals the classes out by length and content hash, inserts their strings into a trie for
each part, and so finds which classes are one. Length and hash only choose where strings meet; what
is equal is decided byte by byte. Strings of one length and hash lie together, so that between
them a full trie can be let go whole.

Edge cases: a null text is an empty one, and so are all blank ones, which are one group; very long
texts are inserted whole (a string is held once in its trie); among rows of equal code points and
id (ties, repeated rows) one stays, whichever was read first; a null id comes after all others, and
is the ``keep_id`` of a group without any other; an empty table gives an empty result; other columns
play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import utf8_bytes, written

#: What is deleted before texts are compared.
BLANKS = b" \t\n\x0b\x0c\r"
#: Bytes of strings that a trie holds before a subtree is spilled.
TRIE_BYTES = 64 << 20
#: Bits of a class number below its task's.
_SERIAL = 36
OUTPUTS = ("keep_id", "group_size", "kept", "text_sha256")


def first_difference(a: bytes, b: bytes) -> int:
    """The first place where two strings of different content differ, found by halving; the shorter length if one begins the other."""
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


class Leaf:
    """A terminal: its string and what its owner keeps there."""

    __slots__ = ("string", "value")

    def __init__(self, string: bytes, value):
        self.string, self.value = string, value


class Branch:
    """A fork: the strings below agree before ``at``; ``below`` has them by their byte there, -1 where a string ends."""

    __slots__ = ("at", "below")

    def __init__(self, at: int, below: dict):
        self.at, self.below = at, below


def _byte(string: bytes, at: int) -> int:
    return string[at] if at < len(string) else -1


class Patricia:
    """A compressed radix trie over byte strings; forks are only where strings part."""

    def __init__(self):
        self.root: Leaf | Branch | None = None
        self.held = 0

    def terminal(self, string: bytes) -> tuple[Leaf, bool]:
        """The string's terminal, and whether it is new."""
        if self.root is None:
            self.root = Leaf(string, None)
            self.held += len(string)
            return self.root, True
        node = self.root
        while isinstance(node, Branch):  # any string of a subtree tells where this one leaves it
            node = node.below.get(_byte(string, node.at)) or next(iter(node.below.values()))
        if node.string == string:
            return node, False
        at, new = first_difference(string, node.string), Leaf(string, None)
        parent, node = None, self.root
        while isinstance(node, Branch) and node.at < at:
            parent, node = node, node.below[_byte(string, node.at)]
        if isinstance(node, Branch) and node.at == at:
            node.below[_byte(string, at)] = new
        else:
            fork = Branch(at, {_byte(string, at): new, _byte(next(self.leaves(node)).string, at): node})
            if parent is None:
                self.root = fork
            else:
                parent.below[_byte(string, parent.at)] = fork
        self.held += len(string)
        return new, True

    @staticmethod
    def leaves(node: Leaf | Branch | None) -> Iterator[Leaf]:
        """The terminals below a node."""
        open_ = [] if node is None else [node]
        while open_:
            node = open_.pop()
            if isinstance(node, Branch):
                open_.extend(node.below.values())
            else:
                yield node

    def spill(self) -> list[Leaf]:
        """The terminals of the root's largest subtree, which is cut off."""
        if not isinstance(self.root, Branch):
            out, self.root = list(self.leaves(self.root)), None
        else:
            sizes = {key: sum(len(leaf.string) for leaf in self.leaves(node)) for key, node in self.root.below.items()}
            out = list(self.leaves(self.root.below.pop(max(sizes, key=sizes.get))))
            if len(self.root.below) == 1:
                self.root = next(iter(self.root.below.values()))
        self.held -= sum(len(leaf.string) for leaf in out)
        return out

    def spill_all(self) -> list[Leaf]:
        """All terminals; the trie is empty then."""
        out, self.root, self.held = list(self.leaves(self.root)), None, 0
        return out


def _rank(chars: int, doc, row: int) -> tuple:
    """What is smallest for the row that stays."""
    return -chars, doc is None, doc, row


def _better(a: tuple, b: tuple) -> bool:
    return a[:2] < b[:2] if a[:2] != b[:2] else (a[3] < b[3] if a[1] or a[2] == b[2] else a[2] < b[2])


def _classes(docs: DataFrame, trie_bytes: int) -> DataFrame:
    """A row for each document (row, id, class) and, among them, one for each class with its string, size and owner."""
    id_type = docs.schema["id"].dataType

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << _SERIAL
        trie, serial, seen = Patricia(), 0, 0
        packer = zstandard.ZstdCompressor(level=1)

        def out(leaves: list[Leaf]) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(leaves), 256):
                part = leaves[lo : lo + 256]
                values = [leaf.value for leaf in part]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([v[2][3] for v in values], pa.int64()), pa.array([v[2][2] for v in values], docs_id), pa.array([v[0] for v in values], pa.int64()),
                        pa.array([packer.compress(leaf.string) for leaf in part], pa.binary()), pa.array([len(leaf.string) for leaf in part], pa.int64()),
                        pa.array([hashlib.sha256(leaf.string).digest() for leaf in part], pa.binary()), pa.array([v[1] for v in values], pa.int64()),
                        pa.array([-v[2][0] for v in values], pa.int64()),
                    ],
                    _COLUMNS,
                )

        docs_id = None
        for batch in batches:
            ids = batch.column("id")
            docs_id = ids.type
            of, first = [], seen
            for doc, text in zip(ids.to_pylist(), utf8_bytes(batch.column("text")), strict=True):
                text = text or b""
                leaf, new = trie.terminal(text.translate(None, BLANKS))
                mine = _rank(len(text) if text.isascii() else len(text.decode("utf-8", "replace")), doc, base + seen)
                if new:
                    leaf.value = [base + serial, 1, mine]
                    serial += 1
                else:
                    leaf.value[1] += 1
                    if _better(mine, leaf.value[2]):
                        leaf.value[2] = mine
                of.append(leaf.value[0])
                seen += 1
                while trie.held > trie_bytes:
                    yield from out(trie.spill())
            n = len(of)
            none = [pa.nulls(n, t) for t in (pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(range(base + first, base + seen), pa.int64()), ids, pa.array(of, pa.int64()), *none], _COLUMNS)
        yield from out(trie.spill_all())

    schema = T.StructType(
        [T.StructField("row", T.LongType()), T.StructField("id", id_type), T.StructField("class", T.LongType()), T.StructField("string", T.BinaryType())]
        + [T.StructField("bytes", T.LongType()), T.StructField("digest", T.BinaryType()), T.StructField("rows", T.LongType()), T.StructField("chars", T.LongType())]
    )
    return docs.mapInArrow(scan, schema)


_COLUMNS = ["row", "id", "class", "string", "bytes", "digest", "rows", "chars"]


def _owned(classes: DataFrame, trie_bytes: int) -> DataFrame:
    """(class, first) of each class as it arrives, and (first, id, row, rows) of each text once: ``first`` is the text's first class."""
    id_type = classes.schema["id"].dataType

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cell = Patricia(), None
        unpacker = zstandard.ZstdDecompressor()
        names = ["class", "first", "owner", "row", "rows", "digest"]

        def out(leaves: list[Leaf]) -> Iterator[pa.RecordBatch]:
            for lo in range(0, len(leaves), 8192):
                values = [leaf.value for leaf in leaves[lo : lo + 8192]]
                first = pa.array([v[0] for v in values], pa.int64())
                owners = [pa.array([v[2][i] for v in values], t) for i, t in ((2, ids), (3, pa.int64()))]
                held = [pa.array([v[1] for v in values], pa.int64()), pa.array([v[3] for v in values], pa.binary())]
                yield pa.RecordBatch.from_arrays([pa.nulls(len(values), pa.int64()), first, *owners, *held], names)

        ids = None
        for batch in batches:
            ids = batch.column("id").type
            rows = zip(*(batch.column(c).to_pylist() for c in ("class", "string", "bytes", "mark", "digest", "chars", "id", "row", "rows")), strict=True)
            firsts, numbers = [], []
            for number, string, size, mark, digest, chars, doc, row, times in rows:
                if cell != (size, mark) and trie.held > trie_bytes:  # what is held is of other cells: it is complete
                    yield from out(trie.spill_all())
                cell = size, mark
                leaf, new = trie.terminal(unpacker.decompress(string, max_output_size=size))
                mine = _rank(chars, doc, row)
                if new:
                    leaf.value = [number, times, mine, digest]
                else:
                    leaf.value[1] += times
                    if _better(mine, leaf.value[2]):
                        leaf.value[2] = mine
                numbers.append(number)
                firsts.append(leaf.value[0])
            none = [pa.nulls(len(firsts), t) for t in (ids, pa.int64(), pa.int64(), pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int64()), pa.array(firsts, pa.int64()), *none], names)
        yield from out(trie.spill_all())

    schema = T.StructType(
        [T.StructField("class", T.LongType()), T.StructField("first", T.LongType()), T.StructField("owner", id_type), T.StructField("row", T.LongType()), T.StructField("rows", T.LongType())]
        + [T.StructField("digest", T.BinaryType())]
    )
    size = (classes.agg(F.sum(F.octet_length("string"))).first()[0] or 0) // (32 << 20)
    parts = max(size + 1, int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    dealt = classes.withColumn("mark", F.xxhash64("digest")).repartition(parts, "bytes", "mark").sortWithinPartitions("bytes", "mark")
    return dealt.select("class", "string", "bytes", "mark", "digest", "chars", "id", "row", "rows").mapInArrow(merge, schema)


def owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """(id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``) of every row of ``docs``.

    Texts are equal when they are identical without their white space. ``kept`` holds for one row of
    each group: that of the most code points, then of the smallest id. ``text_sha256`` is of the text
    without white space.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = written(_classes(rows, trie_bytes), "classes", codec="zstd")
    classes = found.where("string is not null")
    owned = written(_owned(classes, trie_bytes), "owned")
    text = owned.where("class is null").select("first", F.col("owner").alias("keep_id"), F.col("row").alias("__dk_owner"), F.col("rows").alias("group_size"), "digest")
    of = owned.where("class is not null").select(F.col("class").alias("__dk_class"), "first").join(text, "first").drop("first")
    joined = found.where("string is null").select("row", "id", "class").join(of, F.col("class") == F.col("__dk_class"))
    kept, sha = F.col("row") == F.col("__dk_owner"), F.lower(F.hex("digest"))
    return joined.select(F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), sha.alias("text_sha256"))


def keep_owners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group, with all their columns.

    Rows are found again by id and digest; of rows that share both, one of the most code points stays.
    """
    squeezed = F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), r"[\x20\x09-\x0D]+", "")
    stay = owners(docs, id_col, text_col, trie_bytes).where("kept").select(F.col(id_col).alias("__dk_id"), F.col("text_sha256").alias("__dk_sha"))
    marked = docs.withColumns({"__dk_of": F.sha2(squeezed, 256), "__dk_chars": F.coalesce(F.char_length(F.col(text_col)), F.lit(0))})
    found = marked.join(stay, F.col(id_col).eqNullSafe(F.col("__dk_id")) & (F.col("__dk_of") == F.col("__dk_sha")), "left_semi")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    single = found.groupBy(F.col(id_col).alias("__dk_id"), F.col("__dk_of").alias("__dk_sha")).agg(F.max_by(whole, "__dk_chars").alias("__dk_row"))
    return single.select("__dk_row.*")
