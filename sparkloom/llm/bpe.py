"""Byte-level BPE encoding and decoding with an index from each pair to all its positions in a partition."""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame

from .scratch import held, tidy
from .words import chunks

#: Fixed by the vocabulary's format: how a byte-level vocabulary cuts texts before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces whose encoding a worker keeps. Beyond it the older half is forgotten and made anew when met.
KEPT_PIECES = 150_000


def byte_symbols() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairIndexBpe:
    """A vocabulary, and an encoder of many pieces at a time.

    All pieces lie in one list of symbols with links to their neighbours. An index maps each rank (a pair
    that can merge) to the positions where that pair begins; a heap holds the active ranks. Ranks are
    applied in ascending order, each at all its positions, and the lists of the pairs that a merge makes
    are extended. A pair with a merged symbol always ranks after the merge that made the symbol, so one
    pass in ascending order gives each piece what merging it alone would give.
    """

    def __init__(self, definition: str):
        spec = json.loads(definition)
        of_char = byte_symbols()
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(of_char[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.single = [0] * 256
        for c, b in of_char.items():
            self.single[b] = vocab[c]
        self.rank: dict[tuple[int, int], int] = {}
        self.pair: list[tuple[int, int]] = []
        self.made: list[int] = []
        for m in spec["model"]["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            self.rank[vocab[a], vocab[b]] = len(self.pair)
            self.pair.append((vocab[a], vocab[b]))
            self.made.append(vocab[a + b])
        import regex

        self.split = regex.compile(SPLIT)
        self.cut = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.known: dict[str, tuple[int, ...]] = {}

    def merge(self, pieces: list[str]) -> list[tuple[int, ...]]:
        single, rank, pair, made = self.single, self.rank, self.pair, self.made
        symbol: list[int] = []
        starts = [0]
        for p in pieces:
            symbol.extend([single[b] for b in p.encode()])
            symbol.append(-1)  # no pair reaches over it
            starts.append(len(symbol))
        n = len(symbol)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        places: dict[int, list[int]] = {}
        get = rank.get
        for i, ab in enumerate(zip(symbol, symbol[1:])):
            r = get(ab)
            if r is not None:
                if r in places:
                    places[r].append(i)
                else:
                    places[r] = [i]
        active = list(places)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            (a, b), c = pair[r], made[r]
            for i in sorted(places.pop(r)):
                if symbol[i] != a:
                    continue
                j = after[i]
                if symbol[j] != b:
                    continue
                symbol[i], symbol[j] = c, -2
                k = after[j]
                after[i] = k
                before[k] = i
                h = before[i]
                if h >= 0 and (s := get((symbol[h], c))) is not None:
                    if s in places:
                        places[s].append(h)
                    else:
                        places[s] = [h]
                        heapq.heappush(active, s)
                if (s := get((c, symbol[k]))) is not None:
                    if s in places:
                        places[s].append(i)
                    else:
                        places[s] = [i]
                        heapq.heappush(active, s)
        return [tuple([x for x in symbol[s : e - 1] if x >= 0]) for s, e in zip(starts, starts[1:])]

    def pieces(self, text: str) -> list[str | int]:
        """What is merged alone, in order; the id where a special token stands in the text."""
        if self.cut is None or not any(t in text for t in self.special):
            return self.split.findall(text)
        out: list[str | int] = []
        for part in self.cut.split(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out.extend(self.split.findall(part))
        return out

    def encode(self, texts: Iterable[str]) -> list[list[int]]:
        cut = [self.pieces(t) for t in texts]
        known = self.known
        wanted = set()
        for c in cut:
            wanted.update(c)
        new = [p for p in wanted if p not in known]
        for i in (p for p in new if isinstance(p, int)):
            known[i] = (i,)
        new = [p for p in new if not isinstance(p, int)]
        known.update(zip(new, self.merge(new)))
        out = [list(chain.from_iterable(map(known.__getitem__, c))) for c in cut]
        if len(known) > KEPT_PIECES:
            for p in list(known)[: len(known) - KEPT_PIECES // 2]:
                del known[p]
        return out

    def decode(self, ids: Iterable[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _model(shared) -> PairIndexBpe:
    return held(("bpe", hash(shared.value)), lambda: PairIndexBpe(shared.value))


def _share(docs: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:  # a vocabulary file: of fixed size, whatever the corpus
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids: the token ids of each whole text. Null and empty texts have no ids."""
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            for part in chunks(batch, batch.schema.names[1]):
                texts = [t or "" for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(model.encode(texts), pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidy(run, model=True), f"doc_id {kind}, ids array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: ids back to text; bytes that are not UTF-8 become U+FFFD. Null ids give an empty text."""
    shared = _share(encoded, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([model.decode(x or ()) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(tidy(run, model=True), f"doc_id {kind}, text string")


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row: encoded and decoded in one pass.

    Null texts count as empty: no tokens, and the hashes of empty strings. A special token's string in a
    text is that token. Repeated rows each have a row. Texts of any length are whole; other columns of
    docs are not read.
    """
    shared = _share(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = _model(shared)
        name = list(map(str, range(len(model.bytes_of)))).__getitem__
        for batch in batches:
            for part in chunks(batch, batch.schema.names[1]):
                counts, of_ids, of_text = [], [], []
                for ids in model.encode([t or "" for t in part.column(1).to_pylist()]):
                    counts.append(len(ids))
                    of_ids.append(hashlib.sha256(",".join(map(name, ids)).encode()).hexdigest())
                    of_text.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tidy(run, model=True), f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")


def vocabulary_path() -> str:
    """Where the installed public vocabulary lies."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op9_bpe_round_trip(spark, sf_dir: str) -> DataFrame:
    return round_trip(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabulary_path())
