"""Packing token pieces into fixed windows by minimum bin slack (operator 5).

Texts are tokenized once, cut after every ``capacity`` ids, and what is left of
a text is a shorter piece. A window is filled like this: the longest length
that is left seeds it, a subset-sum table (one bit per reachable total) over the
lengths that are left finds the total closest to the capacity, and walking the
table back gives how many pieces of each length make it up. The window is then
repeated as often as the counts allow. Only the counts by length (at most
``capacity`` numbers) reach the driver, and each step uses up a length, so the
plan is bounded by the capacity and not by the data. Pieces find their
window by their rank among the pieces of their length.

Padding: a window is padded to the capacity unless its total is a power of two.

Defined results: a null text is an empty text; every text ends with the end id,
so no text is without ids; repeated rows are packed each on its own; an empty
table gives an empty result.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskweave.llm.tables import Scratch, bound_batches
from riskweave.llm.words import words_of

#: Words whose ids a worker keeps, and bytes of text that are encoded together.
KEPT_WORDS, KEPT_CORES, GROUP_BYTES = 600_000, 50_000, 1_000_000
RANK_ROWS = 256
_TOKENIZERS: dict[str, WordIds] = {}
_TAIL = b".,;:!?"


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


#: The normalizer and splitting for which a text's ids are those of its words, as the vocabulary's file says them.
WORD_KIND = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
WORD_MODEL = {"type": "BPE", "dropout": None, "end_of_word_suffix": "</w>", "byte_fallback": False, "ignore_merges": False}


class WordIds:
    """Ids of texts by way of their words between ASCII white space.

    The vocabulary's splitting drops white space and no token spans it, so the
    ids of a text are those of its words one after another. Words are looked up by
    hash and length in sorted arrays, all words of a group of texts at once; only words that
    the worker has not met lately are encoded.
    """

    def __init__(self, path: str) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        kind = json.loads(self.tokenizer.to_str())
        parts = {"normalizer": kind["normalizer"], "pre_tokenizer": kind["pre_tokenizer"], "post_processor": kind["post_processor"]}
        # Texts of a vocabulary of another kind are encoded as a whole.
        self.by_word = parts == WORD_KIND and all(kind["model"].get(k) == v for k, v in WORD_MODEL.items())
        self.letters = _byte_letters()
        # Parts of words met lately, and those met before them.
        self.cores: dict[bytes, list[int]] = {}
        self.old_cores: dict[bytes, list[int]] = {}
        self.turn = 0
        # Entries in order of hash: hash, bytes of the word, place and number of its ids, turn of the last use.
        self.hash = np.zeros(0, dtype=np.uint64)
        self.size, self.n, self.used = (np.zeros(0, dtype=np.int32) for _ in range(3))
        self.at = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype="<u4")

    def core_ids(self, core: bytes) -> list[int]:
        """Ids of a word or a part of one."""
        known = self.cores.get(core)
        if known is None:
            known = self.old_cores.get(core)
            if known is not None:
                self.cores[core] = known
                return known
            if core.isalpha():  # a-z and A-Z only
                known = [t.id for t in self.tokenizer.model.tokenize(core.lower().decode())]
            else:
                text = core.decode()
                low = text.lower()
                # Latin letters in lower case are in normal form and one word to the merges.
                if low.isalpha() and len(low) == len(text) and max(low) < "\u0250":
                    known = [t.id for t in self.tokenizer.model.tokenize(low.encode().decode("latin-1").translate(self.letters))]
                else:
                    known = self.tokenizer.encode(text, add_special_tokens=False).ids
            if len(self.cores) >= KEPT_CORES:
                self.cores, self.old_cores = {}, self.cores
            if len(core) <= 64:
                self.cores[core] = known
        return known

    def word_ids(self, word: bytes) -> list[int]:
        """Ids of a word; closing punctuation after a letter or digit is apart from it."""
        core = word.rstrip(_TAIL)
        if core and len(core) < len(word) and (core.isalnum() or core.decode().lower()[-1].isalnum()):
            return self.core_ids(core) + self.core_ids(word[len(core) :])
        return self.core_ids(word)

    def learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        found = [self.word_ids(w) for w in words]
        n = np.array([len(f) for f in found], dtype=np.int32)
        at = len(self.ids) + np.cumsum(n, dtype=np.int64) - n
        self.ids = np.concatenate([self.ids, np.array([i for f in found for i in f], dtype="<u4")])
        size = np.array([len(w) for w in words], dtype=np.int32)
        columns = [np.concatenate(c) for c in ((self.hash, hashes), (self.size, size), (self.at, at), (self.n, n))]
        used = np.concatenate([self.used, np.full(len(n), self.turn, dtype=np.int32)])
        # Both parts are in order already, which this sort uses.
        order = np.argsort(columns[0], kind="stable")
        self.hash, self.size, self.at, self.n = (c[order] for c in columns)
        self.used = used[order]

    def forget(self) -> None:
        """Keeps the half that was used last."""
        keep = self.used >= np.partition(self.used, len(self.used) // 2)[len(self.used) // 2]
        self.hash, self.size, self.at, self.n, self.used = (c[keep] for c in (self.hash, self.size, self.at, self.n, self.used))
        self.ids = self.ids[spread(self.at, self.n)]
        self.at = np.cumsum(self.n, dtype=np.int64) - self.n

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text."""
        if not self.by_word:
            found = self.tokenizer.encode_batch([t.decode() for t in texts], add_special_tokens=False)
            return [np.array(f.ids, dtype="<u4") for f in found]
        self.turn += 1
        if len(self.hash) > KEPT_WORDS:
            self.forget()
        joined = b" ".join(texts)
        starts, ends, hashes = words_of(joined)
        if b"<|" in joined:  # what may hold a special token is told apart by case
            sides = np.array([m.start() for m in re.finditer(rb"<\|", joined)])
            for i in np.unique(np.searchsorted(starts, sides, side="right") - 1):
                hashes[i] = xxhash.xxh64_intdigest(joined[starts[i] : ends[i]], seed=1)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        size = (ends - starts)[first]
        place = np.minimum(np.searchsorted(self.hash, distinct), max(0, len(self.hash) - 1))
        new = np.ones(len(distinct), dtype=bool)
        if len(self.hash):
            new = (self.hash[place] != distinct) | (self.size[place] != size)
        if new.any():
            self.learn(distinct[new], [joined[starts[i] : ends[i]] for i in first[new]])
            place = np.searchsorted(self.hash, distinct)
        self.used[place] = self.turn
        at, n = self.at[place][back], self.n[place][back]
        ids = self.ids[spread(at, n)]
        begins = np.cumsum([0, *[len(t) + 1 for t in texts]])
        cuts = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])[np.searchsorted(starts, begins)]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def spread(at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """at[0], at[0] + 1, ... (n[0] of them), at[1], ..."""
    before = np.cumsum(n, dtype=np.int64) - n
    return np.repeat(at - before, n) + np.arange(int(n.sum()))


def word_ids(path: str) -> WordIds:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordIds(path)
    return _TOKENIZERS[path]


PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def cut_pieces(docs: DataFrame, *, id_col: str, text_col: str, tokenizer: str, end_id: int, capacity: int) -> DataFrame:
    """One row per piece of a text: capacity ids each, the last one shorter."""
    end = end_id.to_bytes(4, "little")
    bound_batches(docs.sparkSession)

    def grouped(batch: pa.RecordBatch) -> Iterator[tuple[list, list[bytes]]]:
        """Ids and texts, about GROUP_BYTES at a time."""
        ids, texts, size = [], [], 0
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            raw = text.as_buffer()
            ids.append(doc_id)
            texts.append(raw.to_pybytes() if raw is not None else b"")
            size += len(texts[-1])
            if size >= GROUP_BYTES:
                yield ids, texts
                ids, texts, size = [], [], 0
        yield ids, texts

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for doc_ids, texts in grouped(batch):
                for doc_id, ids in zip(doc_ids, words.encode(texts), strict=True):
                    view = memoryview(ids.tobytes() + end)
                    total = len(view) // 4
                    for start in range(0, total, capacity):
                        piece = view[4 * start : 4 * (start + capacity)]
                        for column, value in zip(rows, (doc_id, start, len(piece) // 4, zlib.crc32(piece), total), strict=True):
                            column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=pa.int64()) for c in rows], ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            )

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return source.mapInArrow(cut, PIECES)


def padding(total: int, capacity: int) -> int:
    return 0 if total & (total - 1) == 0 else capacity - total


def fill_window(counts: dict[int, int], seed: int, capacity: int) -> dict[int, int]:
    """Lengths and counts that fill a window seeded with one piece of ``seed``.

    ``counts`` are the lengths left, without the seed. Bit s of ``reach[i]`` says
    that the first i lengths can add up to s.
    """
    room = capacity - seed
    mask = (1 << (room + 1)) - 1
    lengths = sorted((x for x, n in counts.items() if n and x <= room), reverse=True)
    reach, used = [1], []
    for x in lengths:
        bits, left, step = reach[-1], min(counts[x], room // x), 1
        while left > 0:  # counts doubled: 1, 2, 4, ... and what is left
            step = min(step, left)
            bits |= (bits << (x * step)) & mask
            left -= step
            step *= 2
        reach.append(bits)
        used.append(x)
        if bits >> room & 1:
            break
    full = reach[-1]
    best = full.bit_length() - 1
    if best < room:  # closest to the capacity, or a total that needs no padding
        even = [p for p in (1 << k for k in range(capacity.bit_length())) if seed <= p <= capacity and full >> (p - seed) & 1]
        if even and padding(seed + best, capacity):
            best = even[-1] - seed
    window = {seed: 1}
    for i in range(len(used), 0, -1):
        times = 0
        while not reach[i - 1] >> best & 1:
            best -= used[i - 1]
            times += 1
        if times:
            window[used[i - 1]] = window.get(used[i - 1], 0) + times
    return window


def plan_windows(counts: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Windows as (count by length, times repeated) that use up ``counts``."""
    left, plan = {x: n for x, n in counts.items() if n > 0}, []
    while left:
        seed = max(left)
        left[seed] -= 1
        window = fill_window(left, seed, capacity)
        left[seed] += 1
        times = min(left[x] // n for x, n in window.items())
        plan.append((window, times))
        for x, n in window.items():
            left[x] -= n * times
            if not left[x]:
                del left[x]
    return plan


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 2,
    capacity: int = 4096,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "packing")
    pieces = cut_pieces(docs, id_col=id_col, text_col=text_col, tokenizer=tokenizer, end_id=end_id, capacity=capacity)
    pieces = scratch.write(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())

    # Where the ranks of a length go: ranks first..last-1 fill windows from sequence_id on,
    # `each` pieces of the length per window, from `offset` on.
    taken, places, sequence = dict.fromkeys(counts, 0), [], 0
    for window, times in plan_windows(counts, capacity):
        offset = 0
        for x, n in sorted(window.items(), reverse=True):
            places.append((x, taken[x], taken[x] + n * times, n, sequence, offset))
            taken[x] += n * times
            offset += x * n
        sequence += times
    schema = "__length long, first long, last long, each long, window long, at long"
    places = F.broadcast(spark.createDataFrame(places, schema))  # bounded by the capacity

    # Ranks: a length's pieces are dealt over buckets by hash, ordered in each, and
    # shifted by the buckets before; no length has to meet in one task.
    per_bucket = max(RANK_ROWS, int(total**0.5))
    buckets = F.greatest(F.lit(1), F.ceil(F.col("__n") / per_bucket)).cast("long")
    sized = F.broadcast(spark.createDataFrame(sorted(counts.items()), "__len long, __n long"))  # bounded by the capacity
    dealt = pieces.join(sized, F.col("length") == F.col("__len")).withColumn(
        "bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), buckets)
    )
    key = ["length", "bucket"]
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shift = dealt.groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    shift = scratch.write(shift.select(*key, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift")), "shift")
    inside = Window.partitionBy(*key).orderBy("doc_id", "start", "ids_crc32")
    ranked = dealt.withColumn("inside", F.row_number().over(inside) - 1).join(shift, key)
    ranked = ranked.withColumn("rank", F.col("shift") + F.col("inside"))
    placed = ranked.join(
        places, (F.col("length") == F.col("__length")) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))
    )
    nth = F.col("rank") - F.col("first")
    return placed.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("window") + F.floor(nth / F.col("each"))).cast("long").alias("sequence_id"),
        (F.col("at") + F.pmod(nth, F.col("each")) * F.col("length")).cast("long").alias("offset"),
    )
