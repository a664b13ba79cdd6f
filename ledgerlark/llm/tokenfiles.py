"""Token IDs in patched frame-of-reference blocks.

IDs are cut into blocks of 256. A block stores its minimum, and the differences to it packed at the
width that fits at least ``PERCENT`` of them; wider ones are patched from an exception list
(position, whole difference). Block layout, little-endian: minimum uint32, values uint16, width uint8,
exceptions uint16, packed bits, exception positions uint16, exception differences uint32.

Segments hold consecutive documents (about ``SEGMENT`` ids, one document at least): their blocks as
one payload, the byte offset of every block, and the IDs and lengths of the documents. Segments are
rows of a Parquet folder in ascending document order, so any file system that Spark writes to will
do and a lost task is simply written again. A segment knows how many ids come before it in its part,
``index`` each part's first id number; so every segment's and block's start in the whole sequence follows.

The encoder is the tokenizers library's model. Latin-1 texts are lower-cased and cut into pieces as a
byte array, a slice of a few MB at a time; the distinct pieces are looked up in a table that each worker
keeps, and the model encodes the new ones in one call. Words with other characters (and all words of a
file with another splitter) are looked up and encoded one by one, by the library's own normalizer and
splitter where those do more than lower-case.

Edge cases. Null and empty texts are the end id alone. Null IDs come first; repeated IDs and rows are
ordered by text hash. An empty table gives empty files. Other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common
from .bpe import Memo

BLOCK, PERCENT, SEGMENT = 256, 90, 1 << 16
#: Bytes of texts encoded at a time; pieces in a worker's table, and the longest of them.
SLICE, MOST, LONGEST = 2 << 20, 1 << 20, 64
HEAD = np.dtype([("low", "<u4"), ("n", "<u2"), ("width", "u1"), ("patches", "<u2")])
SCHEMA = ("part int, before long, n_ids long, doc_ids array<long>, counts array<long>, "
          "block_starts array<int>, payload binary")


def pack(ids: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Blocks of an id sequence, one after the other, and the byte offset of each."""
    n = len(ids)
    blocks = -(-n // BLOCK)
    grid = np.empty(blocks * BLOCK, np.uint32)
    grid[:n] = ids
    grid[n:] = ids[-1] if n else 0
    grid = grid.reshape(blocks, BLOCK)
    low = grid.min(axis=1)
    diff = grid - low[:, None]
    fits = np.partition(diff, BLOCK * PERCENT // 100, axis=1)[:, BLOCK * PERCENT // 100]
    width = np.ceil(np.log2(fits.astype(np.float64) + 1)).astype(np.uint8)
    patched = diff > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    patched.reshape(-1)[n:] = False
    head = np.zeros(blocks, HEAD)
    head["low"], head["n"], head["width"], head["patches"] = low, BLOCK, width, patched.sum(axis=1)
    if blocks:
        head["n"][-1] = n - (blocks - 1) * BLOCK
    packed: list = [b""] * blocks
    for w in np.unique(width):
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        some = diff[rows].astype("<u2" if w <= 16 else "<u4")
        bits = np.unpackbits(some.view(np.uint8).reshape(len(rows), BLOCK, some.itemsize), axis=2, count=int(w), bitorder="little")
        flat = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
        for r, line in zip(rows.tolist(), flat):
            packed[r] = line.tobytes()
    out, at, starts = [], 0, np.empty(blocks, np.int64)
    for b in range(blocks):
        piece = head[b].tobytes() + packed[b]
        if head["patches"][b]:
            where = np.flatnonzero(patched[b])
            piece += where.astype("<u2").tobytes() + diff[b][where].astype("<u4").tobytes()
        starts[b] = at
        at += len(piece)
        out.append(piece)
    return b"".join(out), starts


def unpack(payload: bytes, starts: np.ndarray) -> np.ndarray:
    """Ids of consecutive blocks that begin at ``starts``; any run of blocks can be read alone."""
    starts = np.asarray(starts, np.int64)
    raw = np.frombuffer(payload, np.uint8)
    if not len(starts):
        return np.empty(0, np.uint32)
    head = raw[starts[:, None] + np.arange(HEAD.itemsize)].copy().view(HEAD)[:, 0]
    grid = np.zeros((len(starts), BLOCK), np.uint32)
    width = head["width"].astype(np.int64)
    for w in np.unique(width):
        if not w:
            continue
        rows = np.flatnonzero(width == w)
        part = np.zeros((len(rows), BLOCK * w // 8 + 4), np.uint8)  # a last value's bytes may be sought past the end
        part[:, :-4] = raw[starts[rows][:, None] + HEAD.itemsize + np.arange(BLOCK * w // 8)]
        bit = np.arange(BLOCK) * w
        values = np.zeros((len(rows), BLOCK), np.uint32 if w <= 25 else np.uint64)
        for k in range((w + 14) // 8):  # the bytes that a value may reach into
            values |= part[:, bit // 8 + k].astype(values.dtype) << values.dtype.type(8 * k)
        grid[rows] = values >> (bit % 8).astype(values.dtype) & values.dtype.type((1 << int(w)) - 1)
    for b in np.flatnonzero(head["patches"]).tolist():
        k = int(head["patches"][b])
        at = int(starts[b] + HEAD.itemsize + BLOCK * width[b] // 8)
        grid[b, np.frombuffer(payload, "<u2", k, at)] = np.frombuffer(payload, "<u4", k, at + 2 * k)
    grid += head["low"][:, None]
    full = np.arange(BLOCK)[None] < head["n"][:, None]
    return grid[full]


#: The parts of a tokenizers file that ``WordEncoder`` can run word by word itself; others go through the library.
PLAIN_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
#: A split pattern that takes a run of letters as one piece.
LETTERS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
SPACE, LETTER, NUMBER, OTHER = range(4)
#: Kind of each Latin-1 character in that pattern, and its lower case.
KINDS = bytes(SPACE if c.isspace() else LETTER if c.isalpha() else NUMBER if c.isnumeric() else OTHER for c in map(chr, range(256)))
LOWER = bytes(ord(chr(b).lower()) for b in range(256))
#: White space to Python, but not to the library; control characters that a word number is written with.
SEPARATORS, MARKS = "\x1c\x1d\x1e\x1f", bytes(b for b in range(0x80, 0xa0) if b != 0x85)
#: A character that is no Latin-1 white space; one that keeps a word from being cut as Latin-1.
INSIDE, ODD = r"[^ \t-\r\x85\xa0]", r"[\x1c-\x1f\x80-\x84\x86-\x9f\u0100-\U0010ffff]"
PLAIN_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def byte_letters() -> list[str]:
    """The character that stands for each byte in a byte-level vocabulary: itself if printable, else one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


def cut_latin(raw: bytes) -> tuple[np.ndarray, pa.Array]:
    """Where the pieces of a Latin-1 text begin by the pattern ``LETTERS``, and their lower-cased bytes."""
    text, kind = (np.frombuffer(raw.translate(t), np.uint8) for t in (LOWER, KINDS))
    shown = kind != SPACE
    first = np.diff(kind, prepend=kind[:1]) != 0
    first[:1] = True
    first |= kind == NUMBER
    first &= shown
    at = np.flatnonzero(text[:-1] == ord("'"))
    at = at[first[at] & (kind[at + 1] == LETTER)]  # an apostrophe alone before letters
    one, two = text[at + 1], np.append(text, np.zeros(1, np.uint8))[at + 2]
    short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
    long = np.isin(one, np.frombuffer(b"rv", np.uint8)) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
    first[at[short | long] + 1] = False
    rest = np.concatenate([at[short] + 2, at[long] + 3])
    rest = rest[rest < len(kind)]
    first[rest[kind[rest] == LETTER]] = True
    starts = np.flatnonzero(first)
    body = text[shown]
    ends = np.append((np.cumsum(shown, dtype=np.int32) - 1)[starts], len(body)).astype(np.int32)
    return starts, pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(body)])


class WordEncoder:
    """Texts -> ids of a tokenizers file whose splitter drops white space (little-endian 32-bit bytes).

    A slice is cut as Latin-1; a word that is not, or holds an added token, stands there as its number in
    control characters. Words below U+0300 need no composition, so lower-casing and the file's own split
    pattern are all that its normalizer and splitter do to them; the model is always the library's.
    """

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit
        self.tool = Tokenizer.from_file(path)
        plan = json.loads(self.tool.to_str())
        cuts = (plan.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.cut = None
        if ((plan.get("normalizer") or {}).get("normalizers") == PLAIN_NORMALIZER and len(cuts) == 2 and cuts[1] == PLAIN_BYTES
                and cuts[0].get("type") == "Split" and cuts[0].get("behavior") == "Removed" and cuts[0].get("invert")):
            self.cut = regex.compile(cuts[0]["pattern"]["Regex"]).findall
        self.whole = self.cut is not None and cuts[0]["pattern"]["Regex"] == LETTERS
        self.letters = dict(enumerate(byte_letters())) | {ord(" "): " "}  # no piece has a space; it stands between pieces
        added = [re.escape(t.content) for t in self.tool.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(added)).search if added else lambda word: None
        self.numbers = [i.to_bytes(4, "little") for i in range(1 + max(self.tool.get_vocab().values(), default=0))]
        self.pieces = Memo(self._piece, 1 << 20)
        self.words = Memo(self._word)
        self.table: dict[bytes, bytes] = {}
        odd = "|".join([ODD, *added])
        self.odd = re.compile(f"(?<!{INSIDE}){INSIDE}*?(?:{odd}){INSIDE}*").sub
        self.bulk, self.ends = Tokenizer(self.tool.model), None
        self.bulk.pre_tokenizer = WhitespaceSplit()
        suffix, vocabulary = plan["model"].get("end_of_word_suffix"), self.tool.get_vocab()
        if suffix:  # letters and signs never share a piece, so no piece has such a suffix inside
            self.ends = np.zeros(len(self.numbers), bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True

    def _ids(self, piece: str) -> bytes:
        numbers = self.numbers
        return b"".join([numbers[t.id] for t in self.tool.model.tokenize(piece)])

    def _piece(self, piece: str) -> bytes:
        plain = piece.isascii() and piece.isprintable()  # its bytes stand for themselves (no word has a space)
        return self._ids(piece if plain else piece.encode().decode("latin-1").translate(self.letters))

    def _word(self, word: str) -> bytes:
        if self.added(word):
            return np.array(self.tool.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        if self.cut and (word.isascii() or max(word) < "\u0300"):
            low = word.lower()
            if self.whole and low.isalpha():
                return self.pieces[low]
            return b"".join(map(self.pieces.__getitem__, self.cut(low)))
        cut = self.tool.pre_tokenizer.pre_tokenize_str(self.tool.normalizer.normalize_str(word))
        return b"".join([self._ids(p) for p, _ in cut])

    def _latin(self, text: str, odd: dict[str, int]) -> bytes:
        """The text as Latin-1, its odd words as their numbers in ``odd``."""
        def mark(found):
            return "".join(chr(0x90 + int(digit, 16)) for digit in f"{odd.setdefault(found[0], len(odd)):x}")

        if not self.added(text) and not any(c in text for c in SEPARATORS):
            try:
                raw = text.encode("latin-1")
            except UnicodeEncodeError:
                raw = MARKS
            if text.isascii() or len(raw.translate(None, MARKS)) == len(raw):
                return raw
        return self.odd(mark, text).encode("latin-1")

    def _new(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, from the model in one call."""
        if pieces and self.ends is not None:
            line = b" ".join(pieces).decode("latin-1").encode().decode("latin-1").translate(self.letters)
            ids = np.array(self.bulk.encode_batch_fast([line], add_special_tokens=False)[0].ids, "<u4")
            cuts = (4 * np.flatnonzero(self.ends[ids]) + 4).tolist()
            if len(cuts) == len(pieces):  # else some byte has no token
                raw = ids.tobytes()
                return [raw[i:j] for i, j in zip([0, *cuts], cuts)]
        return [self._piece(p.decode("latin-1")) for p in pieces]

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        if not self.whole:
            return [self._words(t) for t in texts]
        if len(texts) == 1 and len(texts[0] or "") > SLICE:  # a long text is a slice of its own; cut at spaces
            text, ends = texts[0], [0]
            while 0 <= (end := text.find(" ", ends[-1] + SLICE)):
                ends.append(end)
            return [b"".join([self._slice([text[i:j]])[0] for i, j in zip(ends, [*ends[1:], len(text)])])]
        return self._slice(texts)

    def _slice(self, texts: list[str | None]) -> list[bytes]:
        odd: dict[str, int] = {}
        lines = [self._latin(t or "", odd) for t in texts]
        starts, cut = cut_latin(b"\n".join(lines))
        cut = cut.dictionary_encode()
        pieces = cut.dictionary.to_numpy(zero_copy_only=False).tolist()
        known = [*map(self.table.get, pieces)]
        lacking = [i for i, ids in enumerate(known) if ids is None]
        odd_words, marks = [*odd], {*MARKS}
        for i in [i for i in lacking if pieces[i][0] in marks]:
            known[i] = self.words[odd_words[int("".join(f"{b - 0x90:x}" for b in pieces[i]), 16)]]
        lacking = [i for i in lacking if known[i] is None]
        new = dict(zip([pieces[i] for i in lacking], self._new([pieces[i] for i in lacking])))
        for i in lacking:
            known[i] = new[pieces[i]]
        if len(self.table) + len(new) > MOST:  # emptied when full, which costs time only
            self.table.clear()
        self.table.update((p, ids) for p, ids in new.items() if len(p) <= LONGEST)
        sizes, which = np.array([*map(len, known)], np.int64) // 4, cut.indices.to_numpy()
        counts = sizes[which]
        ends = np.append(0, np.cumsum(counts))
        ids = np.frombuffer(b"".join(known), "<u4")[np.repeat((np.cumsum(sizes) - sizes)[which] - ends[:-1], counts) + np.arange(ends[-1])]
        bounds = ends[np.searchsorted(starts, np.cumsum([0, *(len(line) + 1 for line in lines)]))].tolist()
        return [ids[i:j].tobytes() for i, j in zip(bounds, bounds[1:])]

    def _words(self, text: str | None) -> bytes:
        if text and any(c in text for c in SEPARATORS):
            return np.array(self.tool.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return b"".join(map(self.words.__getitem__, (text or "").split()))

    def encode(self, text: str | None) -> bytes:
        return self.encode_all([text])[0]


def _encoder(path: str) -> WordEncoder:
    return common.kept(f"words:{path}", lambda: WordEncoder(path))


def _segments(batches: Iterator[pa.RecordBatch], path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    part, before = TaskContext.get().partitionId(), 0
    end = end_id.to_bytes(4, "little")
    docs, counts, held, size = [], [], [], 0

    def segment():
        payload, starts = pack(np.frombuffer(b"".join(held), "<u4"))
        one = {"part": part, "before": before, "n_ids": size, "doc_ids": docs, "counts": counts,
               "block_starts": starts.tolist(), "payload": payload}
        return pa.RecordBatch.from_pylist([one], schema=pa.schema([
            ("part", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
            ("counts", pa.list_(pa.int64())), ("block_starts", pa.list_(pa.int32())), ("payload", pa.binary())]))

    encoder = _encoder(path)
    for b in common.small_slices(batches, "text", SLICE):
        for doc, ids in zip(b.column("doc_id").to_pylist(), encoder.encode_all(b.column("text").to_pylist())):
            ids += end
            docs.append(doc)
            counts.append(len(ids) // 4)
            held.append(ids)
            size += len(ids) // 4
            if size >= SEGMENT:
                yield segment()
                docs, counts, held, size, before = [], [], [], 0, before + size
    if docs:
        yield segment()


def write(documents: DataFrame, folder: str, tokenizer: str, end_id: int = 1, parts: int | None = None) -> None:
    """Write the ids of all documents, in ascending doc_id, to ``folder``/segments and ``folder``/index."""
    spark = documents.sparkSession
    common.ship(spark)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = documents.select("doc_id", "text").withColumn("text_key", F.xxhash64("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_key")]
    rows = rows.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "text")
    rows.mapInArrow(lambda batches: _segments(batches, tokenizer, end_id), SCHEMA).write.parquet(f"{folder}/segments")
    # one row per part
    sums = spark.read.schema(SCHEMA).parquet(f"{folder}/segments").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    start = F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    sums.withColumn("start", F.coalesce(start, F.lit(0))).write.parquet(f"{folder}/index")


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Segments with ``start``, the number of ids before them."""
    segments = spark.read.schema(SCHEMA).parquet(f"{folder}/segments")
    index = spark.read.schema("part int, n_ids long, start long").parquet(f"{folder}/index").select("part", F.col("start").alias("__start"))
    rows = segments.join(F.broadcast(index), "part")  # a row per written part: as many as the write had tasks
    return rows.withColumn("start", F.col("__start") + F.col("before")).drop("__start")


def documents_of(segments: DataFrame) -> DataFrame:
    """Per document, from the blocks: doc_id, start, n_tokens, ids (binary, little-endian unsigned 32-bit)."""
    return _each(segments, lambda ids: ids.astype("<u4").tobytes(), pa.binary(), "ids binary")


def checksums(segments: DataFrame) -> DataFrame:
    """Per document, from the blocks: doc_id, start, n_tokens, ids_crc32."""
    return _each(segments, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64(), "ids_crc32 long")


def _each(segments, of, kind, column):
    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                ids = unpack(row["payload"], np.array(row["block_starts"], np.int64))
                ends = np.cumsum(row["counts"])
                at = ends - row["counts"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array(at + row["start"], pa.int64()), pa.array(row["counts"], pa.int64()),
                     pa.array([of(ids[i:j]) for i, j in zip(at.tolist(), ends.tolist())], kind)],
                    names=["doc_id", "start", "n_tokens", column.split()[0]])

    return segments.select("start", "doc_ids", "counts", "block_starts", "payload").mapInArrow(
        run, f"doc_id long, start long, n_tokens long, {column}")
