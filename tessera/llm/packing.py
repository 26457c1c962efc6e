"""Packing documents into token sequences: best fit, then a swap-based local search on underfull bins.

Pieces are dealt by hash into groups of bounded size. In a group they are placed best-fit decreasing; then moves,
one-for-one and two-for-one exchanges between underfull bins raise the sum of squared fills, so that the emptiest
bins drain until they vanish. What is left underfull in any group is packed once more across groups, so the number
of groups costs hardly any sequences.

Defined results: a null text is empty and gives the one closing id; an empty table gives no rows; repeated rows are
packed as often as they occur; a null doc_id stays null. Further columns of the input are not carried.
"""

from __future__ import annotations

import re
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import parts, prepare, saved

#: Words with their ids that a worker remembers: twice this many at most. Fewer cost time only.
REMEMBERED = 120_000
PIECES = "doc_id long, piece int, start long, length long, ids binary"


def byte_ranks(model: dict) -> dict[bytes, int] | None:
    """The vocabulary of a byte-level BPE with word ends as bytes -> id, the word end as the byte 0xFF, which UTF-8 never
    has; None unless ids also give the order of merges, so that merging by least id is the same."""
    suffix = model.get("end_of_word_suffix")
    if model.get("type") != "BPE" or not suffix or model.get("dropout"):
        return None
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]  # bytes that stand for themselves
    char_of = {b: chr(b) for b in shown} | {b: chr(256 + n) for n, b in enumerate(b for b in range(256) if b not in set(shown))}
    vocab = model["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    made = [vocab[a + b] for a, b in pairs]
    own = {c: vocab.get(c) for b in range(256) for c in (char_of[b], char_of[b] + suffix)}
    if None in own.values() or max(own.values()) >= made[0] or any(x >= y for x, y in zip(made, made[1:], strict=False)):
        return None
    byte_of = {c: b for b, c in char_of.items()}
    ranks = {}
    for token, id_ in vocab.items():
        end = token.endswith(suffix) and token != suffix
        core = token[: -len(suffix)] if end else token
        if any(c not in byte_of for c in core):
            return None
        ranks[bytes(byte_of[c] for c in core) + (b"\xff" if end else b"")] = id_
    return ranks if len(ranks) == len(vocab) else None


class WordEncoder(dict):
    """Token ids of texts; as a mapping, the ids of each word, encoded once while it is remembered.

    For tokenizers that never join characters across a space or line feed (their pre-tokenizer drops white space), lower-case, and take
    a run of letters and a run of other marks as separate words. So ASCII letters may be lower-cased at once, and
    a comma or full stop between a letter and white space is a word of its own, which leaves far fewer distinct words.
    Words of Latin letters, which normalisation only lower-cases, are merged by the same vocabulary in a faster
    implementation; all other words go to the tokenizer itself. Words not used since the memory last turned over are
    forgotten.
    """

    def __init__(self, path: str) -> None:
        import json
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.older: dict[str, bytes] = {}
        self.merge = None
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        special = {t.content for t in self.tokenizer.get_added_tokens_decoder().values()}
        ranks = byte_ranks(model | {"vocab": {k: v for k, v in model["vocab"].items() if k not in special}})
        if ranks and sys.byteorder == "little" and array("I").itemsize == 4:
            import tiktoken

            self.merge = tiktoken.Encoding("words", pat_str=".+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece

    def plain(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            low = word.lower()
            if self.merge and low.isalpha() and word.isalpha() and (low.isascii() or max(low) < "\u0250"):
                ids = array("I", self.merge(low.encode() + b"\xff")).tobytes()
            else:
                ids = self.plain([word])[0]
        self[word] = ids
        return ids

    def words(self, text: str) -> list[str]:
        if "<|" not in text:  # a special token's name is taken as it is written
            text = _MARK.sub(r" \1", text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass"))
        return text.replace("\n", " ").split(" ")

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self) > REMEMBERED:
            self.older = dict(self)
            self.clear()
        return [b"".join(map(self.__getitem__, self.words(t))) for t in texts]


_MARK = re.compile(r"(?<=[a-z])([.,])(?=[ \n]|$)")
_encoders: dict[str, WordEncoder] = {}


def encode_texts(texts: list[str], path: str, by_word: bool = True) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers; ``by_word`` as ``WordEncoder`` says."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path].encode(texts) if by_word else _encoders[path].plain(texts)


def tokenized_pieces(docs: DataFrame, tokenizer_path: str, limit: int = 4096, closing_id: int = 1, by_word: bool = True) -> DataFrame:
    """One row per piece (PIECES). Only documents of more than ``limit`` ids are cut; ids holds the piece's ids."""
    prepare(docs.sparkSession)
    end = np.asarray([closing_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())])
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                b = batch.slice(at, 500)
                out: list[tuple] = []
                for doc, ids in zip(b.column("doc_id").to_pylist(), encode_texts(b.column("text").to_pylist(), tokenizer_path, by_word), strict=True):
                    ids += end
                    out += [(doc, k, k * limit, (len(cut := ids[s : s + 4 * limit])) // 4, cut) for k, s in enumerate(range(0, len(ids), 4 * limit))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(run, PIECES)


def best_fit(lengths: np.ndarray, limit: int) -> np.ndarray:
    """Bin of each piece, longest pieces first, each into the fullest bin that still takes it."""
    free: dict[int, list[int]] = {}
    mask, bins = 0, 0
    place = np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        if fit := mask >> n:
            room = (fit & -fit).bit_length() - 1 + n
            own = free[room]
            at = own.pop()
            if not own:
                mask &= ~(1 << room)
        else:
            room, at = limit, bins
            bins += 1
        place[i] = at
        if left := room - n:
            free.setdefault(left, []).append(at)
            mask |= 1 << left
    return place


def local_search(lengths: np.ndarray, place: np.ndarray, limit: int, donors: int = 24, rounds: int = 40) -> np.ndarray:
    """Moves and exchanges between underfull bins that raise the sum of squared fills; emptied bins vanish.

    A step takes items of total length d more from donor A than it returns from receiver B; the sum of squares rises
    if fill(B) + d > fill(A). The emptiest bins are donors first, so each gain takes them nearer to empty.
    """
    place = place.copy()
    fill = np.bincount(place, weights=lengths).astype(np.int64)
    open_ = np.flatnonzero((fill < limit) & (fill > 0))
    if len(open_) < 2:
        return place
    items = np.flatnonzero(np.isin(place, open_))
    size = lengths[items]

    def gain(give: int, from_bin: int) -> tuple[int, int]:
        """(d, index in items or -1 for a plain move to a bin, with that bin below): the best receiver for ``give``."""
        at = place[items]
        d = give - size
        ok = (d > 0) & (fill[at] + d <= limit) & (fill[at] + d > fill[from_bin]) & (at != from_bin)
        return (int(d[k]), k) if ok.any() and (k := int(np.argmax(np.where(ok, d, 0)))) >= 0 else (0, -1)

    for _ in range(rounds):
        moved = False
        alive = open_[fill[open_] > 0]
        for donor in alive[np.argsort(fill[alive], kind="stable")][:donors].tolist():
            own = items[place[items] == donor]
            own = own[np.argsort(-lengths[own], kind="stable")].tolist()
            for i in own:
                n = int(lengths[i])
                rooms = np.where((open_ != donor) & (fill[open_] + n <= limit) & (fill[open_] + n > fill[donor]) & (fill[open_] > 0), fill[open_], -1)
                best = int(np.argmax(rooms))
                if rooms[best] >= 0:
                    place[i] = open_[best]
                    fill[donor] -= n
                    fill[open_[best]] += n
                    moved = True
                    continue
                d, k = gain(n, donor)
                if d:
                    j, other = int(items[k]), int(place[items[k]])
                    place[i], place[j] = other, donor
                    fill[donor] -= d
                    fill[other] += d
                    moved = True
            own = items[place[items] == donor].tolist()
            pairs = [(int(lengths[a] + lengths[b]), a, b) for x, a in enumerate(own[:12]) for b in own[x + 1 : 12]]
            for n, a, b in sorted(pairs, reverse=True)[:8]:
                if place[a] != donor or place[b] != donor:
                    continue
                d, k = gain(n, donor)
                if d:
                    j, other = int(items[k]), int(place[items[k]])
                    place[a] = place[b] = other
                    place[j] = donor
                    fill[donor] -= d
                    fill[other] += d
                    moved = True
        if not moved:
            break
    return place


def _pack_group(table: pa.Table, limit: int, round_: int, settle: float) -> pa.Table:
    lengths = table.column("length").to_numpy().astype(np.int64)
    place = local_search(lengths, best_fit(lengths, limit), limit)
    _, place = np.unique(place, return_inverse=True)
    order = np.lexsort((table.column("piece").to_numpy(), place))
    table, place, lengths = table.take(pa.array(order)), place[order], lengths[order]
    fill = np.bincount(place, weights=lengths)
    before = np.cumsum(lengths) - lengths
    first = np.r_[True, place[1:] != place[:-1]]
    offset = before - np.maximum.accumulate(np.where(first, before, 0))
    base = (np.int64(round_) << np.int64(58)) + (table.column("g").to_numpy().astype(np.int64) << np.int64(20))
    return (
        table.drop_columns(["g"]).append_column("sequence_id", pa.array(base + place, pa.int64()))
        .append_column("offset", pa.array(offset.astype(np.int64), pa.int64())).append_column("settled", pa.array(fill[place] >= settle * limit))
    )


def place_pieces(pieces: DataFrame, limit: int = 4096, group: int = 6000) -> DataFrame:
    """``pieces`` (doc_id, piece, length and any narrow columns) with sequence_id and offset.

    Groups hold about ``group`` pieces, less than 2**20 by far; their number follows the input.
    """
    spark = pieces.sparkSession
    pieces = saved(pieces, "pieces")

    def packed(df: DataFrame, round_: int, settle: float) -> DataFrame:
        rows = df.count()
        groups = max(1, -(-rows // group))
        schema = df.schema.simpleString()[len("struct<") : -1].replace(":", " ") + ", sequence_id long, offset long, settled boolean"
        dealt = df.withColumn("g", F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(groups)).cast("long"))
        return dealt.repartition(min(groups, parts(spark, rows, 4 * group)), "g").groupBy("g").applyInArrow(lambda t: _pack_group(t, limit, round_, settle), schema)

    first = saved(packed(pieces, 0, 0.985), "packed")
    rest = first.where("not settled").drop("sequence_id", "offset", "settled")
    return first.where("settled").unionByName(packed(rest, 1, 0.0)).drop("settled")


def pack_documents(docs: DataFrame, tokenizer_path: str, limit: int = 4096, closing_id: int = 1, group: int = 6000, by_word: bool = True) -> DataFrame:
    """Tokenize and pack ``docs`` (doc_id, text): doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = tokenized_pieces(docs, tokenizer_path, limit, closing_id, by_word)
    return place_pieces(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), limit, group)


def sequences(placed: DataFrame, pieces: DataFrame) -> DataFrame:
    """The packed sequences themselves: sequence_id, n_pieces, ids (all pieces' ids in order, 4 bytes each).

    ``placed`` and ``pieces`` meet on (doc_id, piece), which must be unique; a sequence holds at most the limit.
    """
    rows = placed.select("doc_id", "piece", "sequence_id", "offset").join(pieces.select("doc_id", "piece", "ids"), ["doc_id", "piece"])
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    hexed = F.array_join(F.transform(ordered, lambda x: F.hex(x["ids"])), "")
    return rows.groupBy("sequence_id").agg(F.count("*").alias("n_pieces"), F.unhex(hexed).alias("ids"))
