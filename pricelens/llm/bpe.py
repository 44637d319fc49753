"""BPE encoding and decoding through a table of distinct words.

1. One Python pass cuts each text at white space (the tokenizer never joins
   across it), normalises and cuts every distinct stretch of a block of
   documents by the tokenizer's own pattern, and numbers the words.  A block
   row holds the numbers of all its documents in order; a word row holds the
   block's distinct words that fall into one hash bucket.  Both are written
   once, packed.
2. Word rows are dealt by bucket, so every copy of a word meets in one task,
   which merges each distinct word once (again only where a task has seen more
   than ``KNOWN_WORDS`` of them since: its table is bounded).
3. Ids return to their block, are put back by position, and are decoded by a
   lookup join with the id-to-piece table.

Only the tokenizer file is broadcast (fixed size, under 2 MB).  A block closes
at ``block_words`` words, so a task's memory does not grow with the input; a
very long text is a block of its own.  A frequent word has one entry per
block, not one per occurrence, and the buckets follow the session's shuffle
partitions.

Null text counts as empty; an empty text has no ids and decodes to ''.  Rows
with the same or a null id are encoded independently; an empty table gives no
rows.  The control characters 1C-1F are not white space to the tokenizer.
Characters that Unicode assigned after the interpreter's own tables (15.1 in
Python 3.13) may be cut differently from the library.
"""

from __future__ import annotations

import json
import re
import unicodedata
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from pricelens.llm.common import lanes, table, written

BLOCK_WORDS = 4_000_000
OUT_TOKENS = 1_000_000
KNOWN_WORDS = 500_000
# letters whose normal form is themselves, then ASCII signs: the usual word, without the full pattern
PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")
SPACE = re.compile(r"[\t-\r \x85\xa0  -     　]+")
ODD = re.compile(r"[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The visible character that byte-level BPE writes for each byte: printable
    Latin-1 bytes stand for themselves, the others follow from 256 upward."""
    keep = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in keep else chr(next(spare)) for b in range(256)]


class WordBpe:
    """A word-end BPE tokenizer read from a tokenizers JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.vocab = model["vocab"]
        self.rank = {tuple(m): k for k, m in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"], regex.V0)
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.letters = byte_letters()
    def pieces(self) -> list[tuple[int, str]]:
        return [(i, p) for p, i in {**self.vocab, **self.special}.items()]

    def merge(self, part: str) -> list[int]:
        """Ids of one cut part: lowest-ranked pair first, leftmost among equals."""
        seq = [self.letters[b] for b in part.encode("utf-8", "surrogatepass")]
        seq[-1] += self.suffix
        get, none = self.rank.get, 1 << 60
        ranks = [get(pair, none) for pair in pairwise(seq)]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            at = ranks.index(best)
            seq[at:at + 2] = [seq[at] + seq[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = get((seq[at - 1], seq[at]), none)
            if at < len(ranks):
                ranks[at] = get((seq[at], seq[at + 1]), none)
        return [self.vocab[s] for s in seq]

    def word_ids(self, word: str) -> list[int]:
        return [self.special[word]] if word in self.special else self.merge(word)

    def words(self, stretch: str) -> list[str]:
        """The words of a stretch without white space.  A special token is a
        word of its own; no other word mixes letters with signs."""
        plain = PLAIN.fullmatch(stretch)
        if plain:
            return [plain[1].lower(), plain[2]] if plain[2] else [plain[1].lower()]
        parts = self.special_cut.split(stretch) if self.special_cut and "<|" in stretch else [stretch]
        out: list[str] = []
        for part in parts:
            if part in self.special:
                out.append(part)
            elif part:
                out += self.parts(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())
        return out

    def parts(self, norm: str) -> list[str]:
        """The tokenizer's own cut.  Characters that Unicode has not assigned in
        the interpreter's tables are neither letters nor digits."""
        if norm.isascii() or not any(unicodedata.category(c) == "Cn" for c in norm):
            return self.cut.findall(norm)
        masked = "".join("\uffff" if unicodedata.category(c) == "Cn" else c for c in norm)
        return [norm[m.start():m.end()] for m in self.cut.finditer(masked)]


def words_of(text: str) -> list[str]:
    return SPACE.split(text) if ODD.search(text) else text.split()


FIELDS = ("block string, bucket int, doc_ids array<{id}>, counts array<long>, numbers binary, buckets binary, "
          "words binary")


def pack(a: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, byte planes apart, compressed."""
    planes = np.ascontiguousarray(a.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(a).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpack(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 4 * n, codec="zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


class WordTable(dict):
    """Stretch -> tuple of word numbers, numbering new words on the way."""

    def __init__(self, bpe: WordBpe):
        self.bpe = bpe
        self.number: dict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__

    def __missing__(self, stretch: str) -> tuple[int, ...]:
        got = self[stretch] = tuple(map(self.number.__getitem__, self.bpe.words(stretch)))
        return got


def number_words(spec, id_type: pa.DataType, block_words: int, n_buckets: int):
    """Batches of (doc_id, text) -> block rows (bucket null) and word rows."""
    schema = pa.schema([("block", pa.string()), ("bucket", pa.int32()), ("doc_ids", pa.list_(id_type)),
                        ("counts", pa.list_(pa.int64())), ("numbers", pa.binary()), ("buckets", pa.binary()),
                        ("words", pa.binary())])

    def rows(block: str, ids, counts, numbers, words) -> Iterator[pa.RecordBatch]:
        # frequent words get small numbers: the number planes then pack best
        flat, words = np.concatenate(numbers), list(words)
        by_use = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
        renumber = np.empty(len(words), np.uint32)
        renumber[by_use] = np.arange(len(words), dtype=np.uint32)
        words = [words[k] for k in by_use.tolist()]
        bucket = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % n_buckets for w in words),
                             np.uint32, len(words))
        yield pa.RecordBatch.from_pylist([{"block": block, "doc_ids": ids, "counts": counts, "buckets": pack(bucket),
                                           "numbers": pack(renumber[flat])}], schema)
        order = np.argsort(bucket, kind="stable")
        at = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        out = []
        for b in np.flatnonzero(np.diff(at)).tolist():
            own = [words[k] for k in order[at[b]:at[b + 1]]]
            raw = "\n".join(own).encode("utf-8", "surrogatepass")
            out.append({"block": block, "bucket": b,
                        "words": len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)})
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    def run(batches):
        from pyspark import TaskContext
        part, made = TaskContext.get().partitionId(), 0
        bpe = WordBpe(spec.value)
        seen, ids, counts, numbers, size = WordTable(bpe), [], [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = np.fromiter(chain.from_iterable(map(seen.__getitem__, words_of(text.as_py() or ""))), np.uint32)
                ids.append(doc_id)
                counts.append(len(own))
                numbers.append(own)
                size += len(own)
                if size >= block_words:
                    yield from rows(f"{part}-{made}", ids, counts, numbers, seen.number)
                    made, seen, ids, counts, numbers, size = made + 1, WordTable(bpe), [], [], [], 0
        if ids:
            yield from rows(f"{part}-{made}", ids, counts, numbers, seen.number)
    return run


def encode_words(spec):
    """Word rows of a task's buckets -> (block, bucket, counts and ids packed);
    each distinct word of a bucket is merged once while KNOWN_WORDS hold all of
    them; beyond that the table starts anew, so its size does not follow the
    input and only repeated work, never a result, depends on it."""
    def run(batches):
        bpe, known = WordBpe(spec.value), {}
        for batch in batches:
            if len(known) > KNOWN_WORDS:
                known.clear()
            sizes, ids = [], []
            for blob in batch.column("words").to_pylist():
                raw = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
                got = []
                for w in raw.decode("utf-8", "surrogatepass").split("\n"):
                    one = known.get(w)
                    if one is None:
                        one = known[w] = bpe.word_ids(w)
                    got.append(one)
                sizes.append(pack(np.fromiter(map(len, got), np.uint32, len(got))))
                ids.append(pack(np.fromiter(chain.from_iterable(got), np.uint32)))
            yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("bucket"),
                                              pa.array(sizes, pa.binary()), pa.array(ids, pa.binary())],
                                             ["block", "bucket", "sizes", "ids"])
    return run


def join_back(spec, id_type: pa.DataType):
    """Block rows with the ids of their words -> one row per document, given
    out every OUT_TOKENS ids so that a task holds a part of a block's result."""
    names = ["doc_id", "n_tokens", "ids", "decoded"]

    def words_by_number(coded: list[dict] | None, buckets: np.ndarray, piece: dict[int, str]):
        packed, decoded = [], []
        for one in sorted(coded or [], key=lambda c: c["bucket"]):
            flat = unpack(one["ids"])
            raw, text, start = flat.tobytes(), [piece[i] for i in flat.tolist()], 0
            for end in np.cumsum(unpack(one["sizes"])).tolist():
                packed.append(raw[4 * start:4 * end])
                decoded.append(" ".join(text[start:end]))
                start = end
        order = np.argsort(buckets, kind="stable")
        out = []
        for found in (packed, decoded):
            by_number = np.empty(len(order), object)
            by_number[order] = found
            out.append(by_number)
        return out

    def run(batches):
        bpe = WordBpe(spec.value)
        piece = dict(bpe.pieces())
        del bpe
        for batch in batches:
            for k in range(batch.num_rows):
                row = {c: batch.column(c)[k] for c in batch.schema.names}
                ids, text = words_by_number(row["coded"].as_py(), unpack(row["buckets"].as_py()), piece)
                flat, start, held = unpack(row["numbers"].as_py()), 0, 0
                out = [[], [], [], []]
                for doc_id, size in zip(row["doc_ids"].as_py(), row["counts"].as_py(), strict=True):
                    own = flat[start:start + size]
                    start += size
                    packed = b"".join(ids[own].tolist())
                    for column, value in zip(out, (doc_id, len(packed) // 4, packed, " ".join(text[own].tolist())),
                                             strict=True):
                        column.append(value)
                    held += len(packed) // 4
                    if held >= OUT_TOKENS:
                        yield table_of(out)
                        out, held = [[], [], [], []], 0
                if out[0]:
                    yield table_of(out)

    def table_of(out):
        kinds = (id_type, pa.int64(), pa.binary(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds, strict=True)], names)
    return run


def encode_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                  block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_tokens, ids (little-endian unsigned 32-bit
    integers) and decoded text (pieces with a blank between: the tokenizer
    file names no decoder)."""
    spark = docs.sparkSession
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())
    src = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = src.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)
    n = lanes(spark)
    rows = written(src.mapInArrow(number_words(spec, id_type, block_words, n), FIELDS.format(id=kind.simpleString())))
    coded = (rows.filter("bucket is not null").select("block", "bucket", "words").repartition(n, "bucket")
             .mapInArrow(encode_words(spec), "block string, bucket int, sizes binary, ids binary")
             .groupBy("block").agg(F.collect_list(F.struct("bucket", "sizes", "ids")).alias("coded")))
    blocks = rows.filter("bucket is null").select("block", "doc_ids", "counts", "numbers", "buckets")
    return blocks.join(coded, "block", "left").mapInArrow(
        join_back(spec, id_type), f"doc_id {kind.simpleString()}, n_tokens long, ids binary, decoded string")


def op9_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers
    done = encode_decode(table(spark, sf_dir, "documents", "doc_id", "text"),
                         public_tokenizers.path("word_bpe_49k.json"))
    return done.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
