"""Alignment of two tokenizers over the same bytes, as an Arrow-native pipeline.

Both tokenizers spell a text's bytes; where a token of A and one of B end at the same byte,
the text is cut into groups. Every pair of an A and a B token whose byte ranges overlap is a
link. Per task, texts are worked on some megabytes at a time: the token lists are flattened
with the index of their document, token lengths become ends by cumulative sums that start
anew in each document, and an Acero hash join on (document, end) finds the cuts. Links are
counted by id pair with Table.group_by, and Spark adds the partial counts up.

A document's links need the counts of the whole corpus. Texts are encoded once: a task keeps
a dictionary of the id pairs it has met, and stores each document's links as places in it.
The dictionary of such a block is joined with the corpus-wide counts, and goes back to the
stored links of its block; so what is shuffled is id pairs per block, not links. Blocks are
cut at BLOCK_BYTES of text, so both sides of a block are bounded, but for its last document.

Token bytes: those of A are its entries decoded from the byte-level alphabet; those of B the
piece with U+2581 as space, a byte piece as its byte. A reads the text after one space, B
adds that space itself. Where A's merges are listed in the order of their ids, a faster
encoder with the same ids is used (`Bytes.encode`).

Defined results: texts that are null or empty, and those whose A or B bytes differ from space
and text, have no tokens: zeros, and '' for the groups; strings of special tokens are plain
text; ids are whole numbers, a null id is carried through; rows that repeat count again; an
empty table gives an empty result; other columns are not read. The largest B id bounds the
table of best counts per B id.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm.shared import written

BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Bytes of text encoded together, and those of a block of documents.
TOGETHER, BLOCK_BYTES = 400_000, 24_000_000
MARK = "▁"
#: Fixed value: how byte-level BPE of this kind cuts text into words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# ---------------------------------------------------------------- tokenizers


def byte_alphabet() -> dict[str, int]:
    """The letter of byte-level BPE for each byte: itself where it prints, else the next one from U+0100 on."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(prints)]
    return {chr(b): b for b in prints} | {chr(256 + i): b for i, b in enumerate(rest)}


def _spelt(spellings: list[bytes]) -> pa.Array:
    return pa.array(spellings, pa.large_binary())


class Bytes:
    """A byte-level BPE: `encode` gives ids per text, `spelling` the bytes of each id."""

    def __init__(self, file: str):
        with open(file, encoding="utf-8") as f:
            described = json.load(f)
        letters = byte_alphabet()
        added = {t["id"] for t in described.get("added_tokens", ())}
        vocab = {t: i for t, i in described["model"]["vocab"].items() if i not in added}
        spelt = {i: bytes(letters[c] for c in t) for t, i in vocab.items()}
        self.spelling = _spelt([spelt.get(i, b"") for i in range(max([*spelt, *added], default=-1) + 1)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in described["model"]["merges"]]
        made = [vocab[a + b] for a, b in pairs]
        splitter = described.get("pre_tokenizer") or {}
        ranked = made == list(range(256, 256 + len(made))) and len(vocab) == 256 + len(made)
        self.fast = None
        if ranked and splitter.get("type") == "ByteLevel" and splitter.get("use_regex", True) and not described.get("normalizer"):
            ranks = {word: i for i, word in spelt.items()}
            self.fast = tiktoken.Encoding("byte level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.whole = tokenizers.Tokenizer.from_file(file)
        self.whole.encode_special_tokens = True

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.fast is not None:
            return [self.fast.encode_to_numpy(t, disallowed_special=()).astype(np.int32) for t in texts]
        return [np.array(e.ids, dtype=np.int32) for e in self.whole.encode_batch(texts, add_special_tokens=False)]


class Pieces:
    """A SentencePiece model: `encode` gives ids per text, `spelling` the bytes of each id."""

    def __init__(self, proto: bytes):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=proto)
        size = self.model.get_piece_size()
        pieces = [self.model.id_to_piece(i) for i in range(size)]
        self.spelling = _spelt(
            [
                bytes([int(re.fullmatch("<0x([0-9A-F]{2})>", p)[1], 16)]) if self.model.is_byte(i) else p.replace(MARK, " ").encode()
                for i, p in enumerate(pieces)
            ]
        )

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(ids, dtype=np.int32) for ids in self.model.encode(texts, num_threads=1)]


@lru_cache(maxsize=2)
def _bytes_of(file: str) -> Bytes:
    return Bytes(file)


@lru_cache(maxsize=2)
def _pieces_of(file: str) -> Pieces:
    with open(file, "rb") as f:
        return Pieces(f.read())


# ---------------------------------------------------------------- tokens of some texts


def _lists(ids: list[np.ndarray]) -> pa.LargeListArray:
    ends = np.cumsum([0, *map(len, ids)])
    return pa.LargeListArray.from_arrays(pa.array(ends, pa.int64()), pa.array(np.concatenate([*ids, np.empty(0, np.int32)]), pa.int32()))


def _starts(lists: pa.LargeListArray) -> np.ndarray:
    return lists.offsets.to_numpy()


def _spells(lists: pa.LargeListArray, spelling: pa.Array, wanted: list[bytes]) -> list[bool]:
    """Whether the tokens of each list spell the bytes wanted."""
    joined = spelling.take(lists.flatten())
    starts = _starts(lists)
    data = joined.buffers()[2]
    if data is None:
        return [not w for w in wanted]
    at = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1][starts]
    held = memoryview(data).cast("B")
    return [bytes(held[a:b]) == w for a, b, w in zip(at[:-1], at[1:], wanted, strict=True)]


def _ends(lists: pa.LargeListArray, spelling: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, end, end over all documents) of each token: `end` is summed up from 0 in each document."""
    doc = lists.value_parent_indices()
    size = pc.binary_length(spelling).take(lists.flatten())
    total = pc.cumulative_sum(size).to_numpy()
    starts = _starts(lists)
    before = np.r_[0, total][starts[:-1]]
    return doc.to_numpy(), total - np.repeat(before, np.diff(starts)), total


class Aligned:
    """The tokens of some texts, cut into groups and linked. Texts without tokens have empty lists."""

    def __init__(self, a: pa.LargeListArray, b: pa.LargeListArray, spell_a: pa.Array, spell_b: pa.Array):
        self.a, self.b = a, b
        doc_a, end_a, over_a = _ends(a, spell_a)
        doc_b, end_b, over_b = _ends(b, spell_b)
        left = pa.table({"doc": doc_a, "end": end_a, "at_a": np.arange(len(doc_a))})
        right = pa.table({"doc": doc_b, "end": end_b, "at_b": np.arange(len(doc_b))})
        cuts = left.join(right, keys=["doc", "end"], join_type="inner", use_threads=False)
        self.cut_a, self.cut_b = np.zeros(len(doc_a), dtype=bool), np.zeros(len(doc_b), dtype=bool)
        self.cut_a[cuts["at_a"].to_numpy()] = True
        self.cut_b[cuts["at_b"].to_numpy()] = True
        self.doc_a = doc_a
        self.group_a = np.cumsum(self.cut_a) - self.cut_a
        self.group_b = np.cumsum(self.cut_b) - self.cut_b
        # A token's last link is to the token of B that reaches its end; the next one begins there, or behind a cut.
        last = np.searchsorted(over_b, over_a, side="left")
        first = np.r_[0, last[:-1] + self.cut_a[:-1]] if len(last) else last
        links = last - first + 1
        self.link_doc = np.repeat(doc_a, links)
        from_a = np.repeat(np.arange(len(doc_a)), links)
        from_b = np.arange(int(links.sum())) - np.repeat(np.cumsum(links) - links, links) + np.repeat(first, links)
        self.pair = (a.flatten().to_numpy().astype(np.int64)[from_a] << 32) | b.flatten().to_numpy()[from_b]

    def counts(self, documents: int) -> dict[str, np.ndarray]:
        a, b = np.diff(_starts(self.a)), np.diff(_starts(self.b))
        groups = np.bincount(self.doc_a[self.cut_a], minlength=documents)
        return {"n_a": a, "n_b": b, "n_groups": groups, "n_links": np.bincount(self.link_doc, minlength=documents)}

    def digests(self) -> list[str]:
        """Per document the hash of its groups, written as `a1,a2|b1;a3|b2,b3`; '' without tokens."""
        n_a, n_b = len(self.group_a), len(self.group_b)
        group = np.r_[self.group_a, self.group_b]
        order = np.argsort(group * 2 + np.r_[np.zeros(n_a, np.int64), np.ones(n_b, np.int64)], kind="stable")
        after = np.r_[np.where(self.cut_a, 1, 0), np.where(self.cut_b, 2, 0)][order]  # of , | ;
        ids = np.r_[self.a.flatten().to_numpy(), self.b.flatten().to_numpy()][order]
        text = _decimal(int(ids.max(initial=0))).take(pa.array(ids.astype(np.int64) * 3 + after))
        starts = _starts(self.a) + _starts(self.b)
        at = np.frombuffer(text.buffers()[1], dtype=np.int64)[: len(text) + 1][starts]
        held = memoryview(text.buffers()[2] or b"")
        return [hashlib.sha256(held[a : b - 1]).hexdigest() if b > a else "" for a, b in zip(at[:-1], at[1:], strict=True)]


_written_ids: list[pa.Array] = [pa.array([], pa.large_binary())]


def _decimal(highest: int) -> pa.Array:
    """The texts `0,` `0|` `0;` `1,` and so on, up to the id."""
    if len(_written_ids[0]) < 3 * (highest + 1):
        _written_ids[0] = _spelt([f"{i}{mark}".encode() for i in range(highest + 1) for mark in ",|;"])
    return _written_ids[0]


def aligned(texts: list[str | None], one: Bytes, two: Pieces) -> Aligned:
    held = [t or "" for t in texts]
    wanted = [b" " + t.encode() if t else b"" for t in held]
    a = one.encode([" " + t if t else "" for t in held])
    b = two.encode(held)
    right = [
        x and y
        for x, y in zip(_spells(_lists(a), one.spelling, wanted), _spells(_lists(b), two.spelling, wanted), strict=True)
    ]
    none = np.empty(0, dtype=np.int32)
    kept = [[ids if ok else none for ids, ok in zip(side, right, strict=True)] for side in (a, b)]
    return Aligned(_lists(kept[0]), _lists(kept[1]), one.spelling, two.spelling)


# ---------------------------------------------------------------- blocks


class _Dictionary:
    """The id pairs of a block: each has a place, in the order of arrival, and a count."""

    def __init__(self):
        self.keys, self.places = np.empty(0, np.int64), np.empty(0, np.int32)
        self.counts = np.empty(0, np.int64)

    def add(self, pair: np.ndarray) -> np.ndarray:
        """The places of the pairs, which are counted."""
        found = pa.table({"pair": pair}).group_by("pair", use_threads=False).aggregate([("pair", "count")])
        keys, n = found["pair"].to_numpy(), found["pair_count"].to_numpy()
        order = np.argsort(-n, kind="stable")  # frequent pairs get small places
        keys, n = keys[order], n[order]
        new = keys[~np.isin(keys, self.keys)]
        every = np.r_[self.keys, new]
        places = np.r_[self.places, np.arange(len(self.places), len(every), dtype=np.int32)]
        order = np.argsort(every, kind="stable")
        self.keys, self.places = every[order], places[order]
        self.counts = np.r_[self.counts, np.zeros(len(new), np.int64)]
        self.counts[self.places[np.searchsorted(self.keys, keys)]] += n
        return self.places[np.searchsorted(self.keys, pair)]

    def rows(self) -> pa.RecordBatch:
        order = np.argsort(self.places)
        return pa.RecordBatch.from_arrays(
            [pa.array(self.keys[order]), pa.array(np.arange(len(order)), pa.int32()), pa.array(self.counts)],
            ["pair", "place", "n"],
        )


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_STORED = (
    "block string, pair bigint, place int, n bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "n_links bigint, groups_sha256 string, low binary, high binary"
)
_SCHEMA = pa.schema(
    [
        ("block", pa.string()), ("pair", pa.int64()), ("place", pa.int32()), ("n", pa.int64()), ("doc_id", pa.int64()),
        *[(name, pa.int64()) for name in _COUNTS], ("groups_sha256", pa.string()), ("low", pa.binary()),
        ("high", pa.binary()),
    ]
)


def _batch(columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """Rows of the stored table; columns not given are null."""
    size = len(columns["block"])
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(size, f.type)) for f in _SCHEMA], schema=_SCHEMA)


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str | None], int]]:
    """(ids, texts, bytes), about TOGETHER bytes of text at a time."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy()
        part = np.cumsum(size + 64) // TOGETHER
        for low, high in zip(np.searchsorted(part, u := np.unique(part)), np.searchsorted(part, u, side="right"), strict=True):
            rows = batch.slice(low, high - low)
            yield rows.column("doc_id"), rows.column("text").to_pylist(), int(size[low:high].sum())


def _stored(byte_file: str, piece_file: str):
    """Per document its counts and links; per block its id pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, one, two = TaskContext.get().partitionId(), _bytes_of(byte_file), _pieces_of(piece_file)
        number, held, pairs = 0, 0, _Dictionary()

        def pairs_of(block: str) -> Iterator[pa.RecordBatch]:
            rows = pairs.rows()
            for low in range(0, rows.num_rows, 50_000):
                part = rows.slice(low, 50_000)
                names = pa.array([block] * part.num_rows)
                yield _batch({"block": names, **{c: part.column(c) for c in ("pair", "place", "n")}})

        for ids, texts, size in _some(batches):
            found = aligned(texts, one, two)
            place = pairs.add(found.pair)
            counts = found.counts(len(texts))
            ends = np.cumsum([0, *counts["n_links"]])
            low, high = (place & 0xFFFF).astype("<u2"), (place >> 16).astype("<u2")
            cut = list(zip(ends[:-1], ends[1:], strict=True))
            yield _batch(
                {
                    "block": pa.array([f"{task}-{number}"] * len(texts)),
                    "doc_id": ids,
                    **{c: pa.array(counts[c].astype(np.int64)) for c in _COUNTS},
                    "groups_sha256": pa.array(found.digests()),
                    "low": pa.array([low[i:j].tobytes() for i, j in cut], pa.binary()),
                    "high": pa.array([high[i:j].tobytes() if high[i:j].any() else b"" for i, j in cut], pa.binary()),
                }
            )
            held += size
            if held >= BLOCK_BYTES:
                yield from pairs_of(f"{task}-{number}")
                number, held, pairs = number + 1, 0, _Dictionary()
        if len(pairs.keys):
            yield from pairs_of(f"{task}-{number}")

    return run


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the corpus-wide counts up per document; a block's pairs come before its documents, in order of place."""
    block, count, best = None, [], []
    for batch in batches:
        names = batch.column("block")
        cut = np.flatnonzero(pc.not_equal(names.slice(1), names.slice(0, len(names) - 1)).to_numpy(zero_copy_only=False)) + 1
        for start, stop in zip(np.r_[0, cut], np.r_[cut, len(names)], strict=True):
            if stop == start:
                continue
            rows = batch.slice(start, stop - start)
            if (name := rows.column("block")[0].as_py()) != block:
                block, count, best = name, [], []
            is_pair = rows.column("place").is_valid()
            pairs = rows.filter(is_pair)
            if pairs.num_rows:
                count.append(pairs.column("total").to_numpy())
                best.append(pairs.column("is_best").to_numpy(zero_copy_only=False))
            documents = rows.filter(pc.invert(is_pair))
            if not documents.num_rows:
                continue
            count, best = ([np.concatenate([*x, np.empty(0, np.int64)])] for x in (count, best))
            sums, bests = [], []
            for low, high in zip(documents.column("low").to_pylist(), documents.column("high").to_pylist(), strict=True):
                place = np.frombuffer(low, "<u2").astype(np.int64)
                if high:
                    place |= np.frombuffer(high, "<u2").astype(np.int64) << 16
                sums.append(int(count[0][place].sum()))
                bests.append(int(best[0][place].sum()))
            kept = ["doc_id", *_COUNTS, "groups_sha256"]
            yield pa.RecordBatch.from_arrays(
                [*(documents.column(c) for c in kept), pa.array(bests, pa.int64()), pa.array(sums, pa.int64())],
                [*kept, "n_best", "count_sum"],
            )


# ---------------------------------------------------------------- the operator


def token_alignment(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row per document."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    stored = written(rows.mapInArrow(_stored(byte_file, piece_file), _STORED), "aligned")
    pairs = stored.filter("place IS NOT NULL").select("block", "pair", "place", "n")
    totals = written(pair_counts(pairs), "pair-counts")
    counted = pairs.join(totals.withColumnRenamed("pair", "of"), F.col("pair") == F.col("of"))
    texts = ["doc_id", *_COUNTS, "groups_sha256", "low", "high"]
    none = lambda names: [F.lit(None).cast(stored.schema[n].dataType).alias(n) for n in names]
    sent = counted.select("block", "place", "total", "is_best", *none(texts)).unionByName(
        stored.filter("place IS NULL").select(
            "block", "place", F.lit(None).cast("bigint").alias("total"), F.lit(None).cast("boolean").alias("is_best"), *texts
        )
    )
    summed = sent.repartition("block").sortWithinPartitions("block", F.col("place").asc_nulls_last()).mapInArrow(
        _summed,
        "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint",
    )
    return summed.select("doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256")


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(pair, total, is_best): links of each id pair in the corpus, and whether no other A id has more with its B id."""
    totals = pairs.groupBy("pair").agg(F.sum("n").alias("total"))
    b_id = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = totals.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))
    return totals.join(most, b_id == F.col("b_id")).select("pair", "total", (F.col("total") == F.col("most")).alias("is_best"))
