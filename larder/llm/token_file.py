"""Token ids in binary files: canonical length-limited Huffman codes.

Writing: (1) encode every text and count each id over all documents; (2) make
one code from these global counts by package-merge with lengths of at most
``MAX_BITS``; (3) range-sort the documents by id and write files of
independent blocks.  A block holds whole documents, starts at a 64-bit word and
carries a checkpoint (bit offset) for every ``STRIDE`` ids.  Decoding looks
``MAX_BITS`` bits up in one table; all checkpoints of a block decode side by
side, one id of each per step.  Files are written under temporary names and
moved when whole; the manifest is written last.
"""

from __future__ import annotations

import os
import posixpath
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larder.llm.common import commit_file, filesystem, stored, temporary_name, write_manifest
from larder.session import scratch_dir

MAX_BITS = 18
STRIDE = 256
BLOCK_IDS = 1 << 19
FILE_BYTES = 64 << 20  # payload after which a task begins another file
MAGIC = b"HUFIDS1\n"
CACHE_WORDS = 500_000
CACHE_WORD_CHARS = 64
CHARS_AT_ONCE = 1 << 22  # of texts that are cut together
WORDS_AT_ONCE = 32_768

# Texts of these characters are in normal form C already, their letters have
# simple lower-case forms and each is one byte of Latin-1, so they are cut into
# pre-tokens here; the library does it for all others.
_PLAIN = re.compile(r"[\t\n\r -~À-ÖØ-öø-ÿ]*")
# What a byte is in lower case: 0 white space, 1 letter, 2 digit, 3 other.
_KIND = np.full(256, 3, np.uint8)
_KIND[[9, 10, 13, 32]] = 0
_KIND[[*range(ord("a"), ord("z") + 1), *range(0xDF, 0xF7), *range(0xF8, 0x100)]] = 1
_KIND[ord("0"):ord("9") + 1] = 2


def cut_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pre-tokens of lower-case plain text as the vocabulary file cuts it,
    ``'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+``: the byte where
    each begins, the text without white space and the places of the cuts in it."""
    kind = _KIND[data]
    first = np.empty(len(data), bool)
    first[:1] = True
    np.not_equal(kind[1:], kind[:-1], out=first[1:])
    first |= kind == 2
    first &= kind != 0
    # A contraction: its mark begins a pre-token and letters follow.
    mark = np.flatnonzero((data == ord("'")) & first)
    if len(mark):
        ahead = np.concatenate([data, np.zeros(3, np.uint8)])
        x, y = ahead[mark + 1], ahead[mark + 2]
        one = np.isin(x, np.frombuffer(b"stmd", np.uint8))
        two = (np.isin(x, np.frombuffer(b"rv", np.uint8)) & (y == ord("e"))) | ((x == ord("l")) & (y == ord("l")))
        for hit, length in ((one, 2), (two, 3)):
            at = mark[hit]
            first[at + 1] = False
            end = at + length
            end = end[end < len(data)]
            first[end] |= kind[end] == 1  # letters that go on are a pre-token of their own
    keep = kind != 0
    cuts = np.append(np.flatnonzero(first[keep]), np.count_nonzero(keep))
    return np.flatnonzero(first), data[keep], cuts


class WordEncoder:
    """Whole texts to ids; ids of pre-tokens are remembered in a bounded table.

    Texts are cut many at once; of each different pre-token among them the ids
    are found once and copied to all its places."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.known: dict[bytes, bytes] = {}  # pre-token in Latin-1 -> its ids
        self.lib = Tokenizer.from_file(path)
        size = self.lib.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.added = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.plain = self._cuts_like_pattern(path)
        suffix = self.lib.model.end_of_word_suffix or "\0"
        self.ends_word = np.zeros(size, bool)
        self.ends_word[[i for t, i in self.lib.get_vocab(with_added_tokens=False).items() if t.endswith(suffix)]] = True

    @staticmethod
    def _cuts_like_pattern(path: str) -> bool:
        """Whether the file states the steps that ``cut_words`` takes."""
        import json

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        norm = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        wanted = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        cut = bool(pre) and pre[0]["type"] == "Split" and pre[0]["pattern"].get("Regex") == wanted
        return norm == ["NFC", "Replace", "Lowercase"] and cut and not pre[-1].get("add_prefix_space")

    def encode(self, text: str | None) -> bytes:
        return self.encode_many([text])[0]

    def encode_many(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as the library gives them, as bytes of ``dtype``."""
        out: list[bytes | None] = [None] * len(texts)
        held: list[int] = []
        chars = 0
        for i, t in enumerate(texts):
            if not t:
                out[i] = b""
            elif not self.plain or not _PLAIN.fullmatch(t) or any(a in t for a in self.added):
                out[i] = self._by_library(t)
            else:
                if held and chars + len(t) > CHARS_AT_ONCE:
                    self._encode_plain(texts, held, out)
                    held, chars = [], 0
                held.append(i)
                chars += len(t)
        if held:
            self._encode_plain(texts, held, out)
        return out

    def _encode_plain(self, texts: list[str | None], which: list[int], out: list[bytes | None]) -> None:
        """Put the ids of those texts, all of plain characters, into ``out``."""
        lower = [texts[i].lower().encode("latin-1") for i in which]
        # A line end between texts ends their last pre-tokens.
        begins, data, cuts = cut_words(np.frombuffer(b"\n".join(lower), np.uint8))
        words = pa.Array.from_buffers(pa.large_binary(), len(begins), [None, pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        ids = pa.array(self._ids_of(coded.dictionary.to_pylist()), pa.large_binary()).take(coded.indices)
        _, ends, together = ids.buffers()
        ends = np.frombuffer(ends, np.int64)[ids.offset:ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        together = memoryview(together) if len(ids) else memoryview(b"")
        starts = np.cumsum([0] + [len(x) + 1 for x in lower])
        at = ends[np.searchsorted(begins, starts)].tolist()
        for i, lo, hi in zip(which, at, at[1:], strict=False):
            out[i] = bytes(together[lo:hi])

    def _by_library(self, text: str) -> bytes:
        return np.array(self.lib.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _ids_of(self, words: list[bytes]) -> list[bytes]:
        """Ids of different pre-tokens, remembered or found."""
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > CACHE_WORDS:
            known.clear()
            new = words
        for lo in range(0, len(new), WORDS_AT_ONCE):
            some = new[lo:lo + WORDS_AT_ONCE]
            known.update(zip(some, self._encode_words([w.decode("latin-1") for w in some]), strict=True))
        out = [known[w] for w in words]
        for w in new:
            if len(w) > CACHE_WORD_CHARS:
                del known[w]
        return out

    def _encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of pre-tokens: all in one text, cut where a token ends a word."""
        together = self.lib.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(together.ids, self.dtype)
        end = np.flatnonzero(self.ends_word[ids]) + 1
        if len(end) != len(words) or end[-1] != len(ids):  # a pre-token without such an end
            return [self._by_library(w) for w in words]
        data, size = ids.tobytes(), self.dtype.itemsize
        at = [0, *(end * size).tolist()]
        return [data[i:j] for i, j in zip(at, at[1:], strict=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


# ------------------------------------------------------------------ the code


def code_lengths(counts: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """Lengths of an optimal prefix code of at most ``limit`` bits
    (package-merge); 0 for ids that do not occur."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) > 1 << limit:
        raise ValueError("more ids than codes of that length")
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    order = used[np.argsort(counts[used], kind="stable")]
    weight = counts[order].astype(object if int(counts.sum()) >= 1 << 52 else np.int64)
    # Each level merges the symbols with pairs of the level before; is_symbol
    # says which items of a level are symbols.
    levels, packages = [], weight[:0]
    for _ in range(limit):
        both = np.concatenate([weight, packages])
        at = np.argsort(both, kind="stable")
        levels.append(at < len(weight))
        both = both[at]
        even = len(both) // 2 * 2
        packages = both[0:even:2] + both[1:even:2]
    take = 2 * len(weight) - 2
    n = np.zeros(len(weight), np.int64)
    for is_symbol in reversed(levels):
        chosen = int(is_symbol[:take].sum())
        n[:chosen] += 1  # of a level, the cheapest symbols are taken first
        take = 2 * (take - chosen)
    lengths[order] = n
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for length in range(1, int(lengths.max(initial=0)) + 1):
        ids = np.flatnonzero(lengths == length)
        code <<= length - before
        codes[ids] = np.arange(code, code + len(ids), dtype=np.uint64)
        code, before = code + len(ids), length
    return codes


def decode_table(lengths: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """For every ``limit`` next bits: id << 8 | length."""
    out = np.zeros(1 << limit, np.uint32)
    used = np.flatnonzero(lengths)
    order = used[np.lexsort((used, lengths[used]))]
    span = np.uint64(1) << (np.uint64(limit) - lengths[order].astype(np.uint64))
    filled = np.repeat((order.astype(np.uint32) << np.uint32(8)) | lengths[order].astype(np.uint32), span.astype(np.int64))
    out[:len(filled)] = filled
    return out


def pack(ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(64-bit words with the codes, checkpoints, bits) of a block's ids."""
    n = lengths[ids].astype(np.int64)
    end = np.cumsum(n)
    bits = int(end[-1]) if len(ids) else 0
    start = end - n
    words = np.zeros((bits + 63) // 64 + 1, np.uint64)
    if len(ids):
        word, offset = start >> 6, start & 63
        code = codes[ids]
        over = offset + n - 64  # bits that reach into the next word
        fits = np.where(over <= 0, code << np.maximum(-over, 0).astype(np.uint64), code >> np.maximum(over, 0).astype(np.uint64))
        first = np.flatnonzero(np.diff(word, prepend=-1))
        words[word[first]] = np.add.reduceat(fits, first)
        spill = np.flatnonzero(over > 0)
        shift = (64 - over[spill]).astype(np.uint64)
        words[word[spill] + 1] += code[spill] << shift
    return words[:(bits + 63) // 64], start[::STRIDE].astype(np.uint64), bits


def unpack(words: np.ndarray, checkpoints: np.ndarray, n_ids: int, table: np.ndarray, limit: int = MAX_BITS) -> np.ndarray:
    """The ids of a block."""
    lanes = len(checkpoints)
    out = np.zeros((STRIDE, lanes), np.uint32)
    padded = np.concatenate([words.astype(np.uint64), np.zeros(2, np.uint64)])
    at = checkpoints.astype(np.uint64)
    keep, six, one = np.uint64(64 - limit), np.uint64(63), np.uint64(1)
    low = np.uint32(255)
    for step in range(min(STRIDE, n_ids)):
        live = lanes if step < n_ids - (lanes - 1) * STRIDE else lanes - 1
        pos = at[:live]
        word, offset = (pos >> np.uint64(6)).astype(np.int64), pos & six
        window = (padded[word] << offset) | ((padded[word + 1] >> one) >> (six - offset))
        entry = table[(window >> keep).astype(np.int64)]
        out[step, :live] = entry >> np.uint32(8)
        at[:live] = pos + (entry & low).astype(np.uint64)
    return out.T.reshape(-1)[:n_ids]


# ------------------------------------------------------------------ files

_BLOCK = struct.Struct("<QQQ")  # documents, ids, words


def file_head(lengths: np.ndarray) -> bytes:
    return MAGIC + struct.pack("<II", len(lengths), MAX_BITS) + lengths.tobytes()


def block_bytes(docs: list[tuple[int, bool, int]], ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray) -> bytes:
    words, checkpoints, _ = pack(ids, codes, lengths)
    index = np.array([d for d, _, _ in docs], "<i8"), np.array([f for _, f, _ in docs], "u1"), np.array([n for _, _, n in docs], "<u8")
    return b"".join([_BLOCK.pack(len(docs), len(ids), len(words)), *(a.tobytes() for a in index),
                     checkpoints.astype("<u8").tobytes(), words.astype("<u8").tobytes()])


def read_blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, whether null, numbers of ids, all ids) of each block of a file."""
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not a token file")
    size, limit = struct.unpack("<II", stream.read(8))
    table = decode_table(np.frombuffer(stream.read(size), np.uint8), limit)
    while head := stream.read(_BLOCK.size):
        n_docs, n_ids, n_words = _BLOCK.unpack(head)
        doc = np.frombuffer(stream.read(8 * n_docs), "<i8")
        null = np.frombuffer(stream.read(n_docs), "u1")
        each = np.frombuffer(stream.read(8 * n_docs), "<u8").astype(np.int64)
        checkpoints = np.frombuffer(stream.read(8 * -(-n_ids // STRIDE)), "<u8")
        words = np.frombuffer(stream.read(8 * n_words), "<u8")
        yield doc, null, each, unpack(words, checkpoints, n_ids, table, limit)


# ------------------------------------------------------------------ the job


def _encoded(docs: DataFrame, model_path: str, end_id: int) -> DataFrame:
    """Rows (id, ids as bytes) and, with null bytes, a row of counts per task."""
    rows = docs.select(docs["doc_id"].cast("long").alias("id"), docs["text"].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model_path)
        tail = np.array([end_id], enc.dtype).tobytes()
        counts = np.zeros(max(enc.lib.get_vocab_size(with_added_tokens=True), end_id + 1), np.int64)
        for batch in batches:
            ids = [b + tail for b in enc.encode_many(batch.column("text").to_pylist())]
            for lo in range(0, len(ids), 256):
                counts += np.bincount(np.frombuffer(b"".join(ids[lo:lo + 256]), enc.dtype), minlength=len(counts))
            none = pa.nulls(len(ids), pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(ids, pa.binary()), none], ["id", "ids", "counts"])
        if counts.any():
            yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()),
                                              pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], ["id", "ids", "counts"])

    return rows.mapInArrow(run, "id long, ids binary, counts binary")


def _global_counts(encoded: DataFrame, size: int) -> np.ndarray:
    """Counts of all ids: one number per id of the vocabulary on the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for c in batch.column("counts").to_pylist():
                total += np.frombuffer(zlib.decompress(c), np.int64)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used])], ["token", "n"])

    tasks = encoded.where(F.col("counts").isNotNull()).select("counts")
    each = tasks.mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    out = np.zeros(size, np.int64)
    for row in each.collect():
        out[row.token] = row.n
    return out


def write_tokens(docs: DataFrame, model_path: str, uri: str, end_id: int, file_bytes: int = FILE_BYTES) -> list[dict]:
    """Write the ids of all texts in ascending doc_id order; returns the manifest.

    Null text counts as empty (only the end id).  Null ids come first; rows
    with the same id are ordered by their ids' bytes.  An empty table gives a
    manifest without files.
    """
    spark = docs.sparkSession
    enc = encoder(model_path)
    size = max(enc.lib.get_vocab_size(with_added_tokens=True), end_id + 1)
    dtype = enc.dtype
    encoded = stored(spark, _encoded(docs, model_path, end_id), "token-ids")
    lengths = code_lengths(_global_counts(encoded, size))
    codes = canonical_codes(lengths)
    filesystem(uri)[0].create_dir(filesystem(uri)[1], recursive=True)
    shared = spark.sparkContext.broadcast((lengths, codes))  # one entry per id of the vocabulary

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesys, root = filesystem(uri)
        n_of, code_of = shared.value
        part = TaskContext.get().partitionId()
        files: list[dict] = []
        out = None
        held: list[tuple[int, bool, bytes]] = []
        held_ids = 0

        def flush() -> None:
            nonlocal held, held_ids, out
            if not held:
                return
            if out is None:
                final = posixpath.join(root, f"part-{part:06d}-{len(files):04d}.ids")
                files.append({"final": final, "tmp": temporary_name(final), "docs": 0, "ids": 0, "bytes": 0})
                out = filesys.open_output_stream(files[-1]["tmp"], compression=None)
                out.write(file_head(n_of))
            ids = np.frombuffer(b"".join(b for _, _, b in held), dtype)
            data = block_bytes([(d, f, len(b) // dtype.itemsize) for d, f, b in held], ids, code_of, n_of)
            out.write(data)
            f = files[-1]
            f["docs"] += len(held)
            f["ids"] += len(ids)
            f["bytes"] += len(data)
            held, held_ids = [], 0
            if f["bytes"] >= file_bytes:
                close()

        def close() -> None:
            nonlocal out
            if out is not None:
                out.close()
                commit_file(filesys, files[-1]["tmp"], files[-1]["final"])
                out = None

        for batch in batches:
            for doc, b in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                held.append((doc or 0, doc is None, b))
                held_ids += len(b) // dtype.itemsize
                if held_ids >= BLOCK_IDS:
                    flush()
        flush()
        close()
        cols = [[part] * len(files), list(range(len(files))), [f["final"] for f in files]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string()),
             *(pa.array([f[k] for f in files], pa.int64()) for k in ("docs", "ids", "bytes"))],
            ["part", "seq", "path", "docs", "ids", "bytes"])

    rows = encoded.where(F.col("ids").isNotNull()).select("id", "ids")
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(width, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "ids")
    written = stored(spark, ordered.mapInArrow(run, "part long, seq long, path string, docs long, ids long, bytes long"), "token-manifest")
    files, start = [], 0
    for row in written.orderBy("part", "seq").collect():  # a row per file
        files.append({"path": row.path, "start": start, "docs": row.docs, "ids": row.ids, "bytes": row.bytes})
        start += row.ids
    write_manifest(uri, "manifest.json", {"files": files, "end_id": end_id, "max_bits": MAX_BITS})
    return files


FILES_SCHEMA = "path string, start long"


def read_tokens(spark: SparkSession, files: list[dict]) -> DataFrame:
    """Documents of the manifest's files: doc_id, start (ids before it), ids."""
    return _read(spark, files, digest=False)


def read_token_digests(spark: SparkSession, files: list[dict]) -> DataFrame:
    """As ``read_tokens`` with n_tokens and ids_crc32 in place of the ids."""
    return _read(spark, files, digest=True)


def _read(spark: SparkSession, files: list[dict], digest: bool) -> DataFrame:
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] if digest else ["doc_id", "start", "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist(), strict=True):
                filesys, root = filesystem(path)
                with filesys.open_input_stream(root, compression=None) as stream:
                    for doc, null, each, ids in read_blocks(stream):
                        end = np.cumsum(each)
                        data = ids.astype("<u4")
                        cols = [pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(start + end - each, pa.int64())]
                        cuts = list(zip((end - each).tolist(), end.tolist(), strict=True))
                        if digest:
                            cols += [pa.array(each, pa.int64()), pa.array([zlib.crc32(data[a:b]) for a, b in cuts], pa.int64())]
                        else:
                            offsets = pa.array(np.concatenate([[0], end]).astype(np.int32))
                            cols.append(pa.ListArray.from_arrays(offsets, pa.array(ids.astype(np.int64))))
                        yield pa.RecordBatch.from_arrays(cols, names)
                        start += int(each.sum())

    kind = "doc_id long, start long, " + ("n_tokens long, ids_crc32 long" if digest else "ids array<long>")
    listed = spark.createDataFrame([(f["path"], f["start"]) for f in files], FILES_SCHEMA)
    # A file per task: files are the unit in which they are written and read.
    return listed.repartition(max(1, len(files)), "path").mapInArrow(run, kind)


def write_and_read(docs: DataFrame, model_path: str, end_id: int = 2) -> DataFrame:
    """Write ids of all documents to the shared folder and return what the
    files hold: doc_id, start, n_tokens, ids_crc32."""
    spark = docs.sparkSession
    files = write_tokens(docs, model_path, scratch_dir(spark, "token-files"), end_id)
    return read_token_digests(spark, files)
