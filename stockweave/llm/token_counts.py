"""Token counts of a byte-level BPE without building the tokens.

Offline, every vocabulary string is merged on its own; those that end as one token form a
proven set.  A pre-token of that set counts one; only the rest is merged, by counting.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.pretokens import Generations, pretokens


def byte_alphabet() -> dict[int, str]:
    """The printable stand-in of each byte in vocabulary files: visible Latin-1 characters
    stand for themselves, the others follow from U+0100 on in byte order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}


class Counter:
    """Counts tokens as the ``tokenizers`` library does for a byte-level BPE file."""

    def __init__(self, model: str, memo_size: int = 250_000):
        spec = json.loads(model)
        if spec["normalizer"] or spec["post_processor"] or spec["model"]["ignore_merges"]:
            raise ValueError("only plain byte-level BPE files are supported")
        if spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("the pre-tokenizer must be ByteLevel with its expression and no prefix space")
        added = spec["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
            raise ValueError("added tokens must match without conditions")
        # longest first: of two added tokens at one place the longer is taken
        names = sorted((t["content"] for t in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, names))) if names else None
        alphabet = byte_alphabet()
        back = {c: b for b, c in alphabet.items()}
        merges = [m.split(" ", 1) if isinstance(m, str) else m for m in spec["model"]["merges"]]
        raw = lambda s: bytes(back[c] for c in s)
        self.rank: dict[tuple[bytes, bytes], int] = {}
        for i, (a, b) in enumerate(merges):
            self.rank.setdefault((raw(a), raw(b)), i)
        plain = [raw(v) for v in spec["model"]["vocab"] if all(c in back for c in v)]
        self.single = frozenset(v for v in plain if self.merged(v) == 1)
        self.memo = _Counts(self, memo_size)

    def merged(self, piece: bytes) -> int:
        """Number of parts left after all merges, lowest rank first, leftmost on ties."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        rank, none = self.rank.get, 1 << 60
        if len(parts) > 200:
            return self._merged_long(parts)
        ranks = [rank(p, none) for p in zip(parts, parts[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = rank((parts[i - 1], parts[i]), none)
        return len(parts)

    def _merged_long(self, parts: list[bytes]) -> int:
        """The same for long pieces in n log n: a heap over linked parts."""
        import heapq

        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := self.rank.get((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        left = n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, b""
            after[i] = after[j]
            left -= 1
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := self.rank.get((parts[x], parts[y]))) is not None:
                    heapq.heappush(heap, (r, x, parts[x], parts[y]))
        return left

    def count(self, text: str) -> int:
        """Tokens of a text; an added token inside it counts one and splits the text."""
        get = self.memo.__getitem__
        if self.added is None or not self.added.search(text):
            return sum(map(get, pretokens(text)))
        pieces = self.added.split(text)
        return len(pieces) - 1 + sum(sum(map(get, pretokens(piece))) for piece in pieces)


class _Counts(Generations):
    def __init__(self, counter: Counter, size: int):
        super().__init__(size)
        self.counter = counter

    def compute(self, token: str) -> int:
        piece = token.encode()
        return 1 if piece in self.counter.single else self.counter.merged(piece)


_COUNTERS: dict[bytes, Counter] = {}


def counter_of(model: str) -> Counter:
    digest = hashlib.sha256(model.encode()).digest()
    if digest not in _COUNTERS:
        _COUNTERS[digest] = Counter(model)
    return _COUNTERS[digest]


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_bytes long, n_tokens long, over_limit boolean) of every whole text.

    A null text counts as empty.  Other columns are not carried; repeated rows give
    repeated results, an empty table an empty one.  One map, no shuffle.
    """
    with open(path, encoding="utf-8") as file:
        model = file.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(model)
        for batch in batches:
            counts = [counter.count(x.as_py() or "") for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts, pa.int64())], ["id", "n_bytes", "n_tokens"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.col(text_col)
    rows = docs.select(
        F.col(id_col).alias("id"),
        text.alias("text"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
    )
    out = rows.mapInArrow(run, f"id {kind}, n_bytes long, n_tokens long")
    return out.withColumnRenamed("id", id_col).withColumn("over_limit", F.col("n_tokens") > limit)
