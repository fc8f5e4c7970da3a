"""Subword encoding and decoding through a distinct-word table.

Texts are split into words (the tokenizer's normaliser and splitting rule) in
blocks: a block numbers its distinct words and keeps its texts as numbers.  The
words of all blocks meet by word; each distinct word is encoded once, and its ids
go back to the blocks that have it.  There the ids are joined to the vocabulary's
pieces, and every text is put together by position.

What is shuffled is the distinct words of each block, not the words of each
text.  A block is named by its place in the input and a digest of its words, so
that a block and its words still match if a lost executor's task runs again, and
blocks of copies, whose words are the same, stay apart.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duetto.llm.common import per_process

#: A block ends with its task's input or at about so many characters.
BLOCK_CHARS = 64_000_000
#: Texts whose characters are all below this code point are split by Python's re,
#: with the letters and numbers of that range written out; others by the
#: tokenizer's own code.
PLAIN_BELOW = 0x180
#: The rule and the normaliser that the plain way knows.
PLAIN_RULE = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PLAIN_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
                {"type": "Lowercase"}]


def vocabulary_file(name: str) -> str:
    """The JSON text of a public tokenizer file, by name or path."""
    import public_tokenizers

    path = name if "/" in name else public_tokenizers.path(name)
    with open(path, encoding="utf-8") as f:
        return f.read()


def check_form(spec: dict) -> None:
    """Only byte-level BPE behind a splitting rule, without decoder, is known."""
    pre, model = spec["pre_tokenizer"], spec["model"]
    steps = pre.get("pretokenizers", [])
    if (pre["type"] != "Sequence" or [s["type"] for s in steps] != ["Split", "ByteLevel"]
            or not steps[0].get("invert") or steps[0]["behavior"] != "Removed"
            or "Regex" not in steps[0]["pattern"] or steps[1]["use_regex"]
            or steps[1]["add_prefix_space"] or model["type"] != "BPE" or spec.get("decoder")
            or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"]
                   for t in spec["added_tokens"])):
        raise ValueError("this tokenizer's words can't be encoded one by one")


def plain_rule() -> re.Pattern:
    """``PLAIN_RULE`` for text below ``PLAIN_BELOW``.  There the normaliser only
    lowers letters, one by one, and joins white space, which no word holds."""
    def members(kind: str) -> str:
        return "".join(re.escape(chr(c)) for c in range(PLAIN_BELOW)
                       if unicodedata.category(chr(c))[0] == kind)

    letters, numbers, space = members("L"), members("N"), r"\t-\r \x85\xa0"
    # The dot above, which a lowered capital I with dot leaves, is neither.
    return re.compile(f"[{letters}]+|[{numbers}]|'(?:s|t|re|ve|m|ll|d)|[^{space}{letters}{numbers}]+")


class Splitter:
    """Words of a text, as the tokenizer splits it; special tokens are words."""

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        check_form(spec)
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        rule = spec["pre_tokenizer"]["pretokenizers"][0]
        own = Tokenizer.from_str(json.dumps({
            **spec, "added_tokens": [], "pre_tokenizer": rule, "post_processor": None,
            "model": {**spec["model"], "vocab": {"a": 0}, "merges": []}}))
        self.normal, self.rule = own.normalizer, own.pre_tokenizer
        names = sorted(self.specials, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        plain = (rule["pattern"]["Regex"] == PLAIN_RULE
                 and (spec["normalizer"] or {}).get("normalizers") == PLAIN_NORMAL)
        self.plain = plain_rule() if plain else None
        self.far = re.compile(f"[^\\x00-\\u{PLAIN_BELOW - 1:04x}]")

    def words(self, text: str | None) -> list[str]:
        if not text:
            return []
        parts = self.cut.split(text) if self.cut and "<" in text else [text]
        if self.plain and not self.far.search(text):
            if len(parts) == 1:
                return self.plain.findall(text.lower())
            split = lambda s: self.plain.findall(s.lower())     # noqa: E731
        else:
            def split(s: str) -> list[str]:
                s = self.normal.normalize_str(s) if self.normal else s
                return [w for w, _ in self.rule.pre_tokenize_str(s)]
        out: list[str] = []
        for i, part in enumerate(parts):
            out += [part] if i % 2 else split(part) if part else []
        return out


def _key(vocabulary: str, role: str) -> str:
    return f"bpe {role} {hashlib.blake2b(vocabulary.encode(), digest_size=12).hexdigest()}"


def _splitter(vocabulary: str) -> Splitter:
    return per_process(_key(vocabulary, "splitter"), lambda: Splitter(vocabulary))


def _word_model(vocabulary: str):
    """The tokenizer without normaliser and splitting rule, for words."""
    def build():
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")    # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        return Tokenizer.from_str(json.dumps({
            **spec, "added_tokens": [], "normalizer": None, "post_processor": None,
            "truncation": None, "padding": None,
            "pre_tokenizer": spec["pre_tokenizer"]["pretokenizers"][1]}))

    return per_process(_key(vocabulary, "words"), build)


class _Numbers(dict):
    """Words by number, in the order in which they came."""

    def __missing__(self, word: str) -> int:
        n = self[word] = len(self)
        return n


class Numbered:
    """One block: its distinct words, and its texts as word numbers."""

    def __init__(self) -> None:
        self.numbers = _Numbers()
        self.texts: list[np.ndarray] = []
        self.chars = 0

    def add(self, text: str | None, splitter: Splitter) -> None:
        words = splitter.words(text)
        self.texts.append(np.fromiter(map(self.numbers.__getitem__, words), dtype=np.uint32,
                                      count=len(words)))
        self.chars += len(text or "")

    def words(self) -> list[str]:
        """The words, the frequent ones first, and the texts numbered so: small
        numbers take less room in the shuffle."""
        count = np.zeros(len(self.numbers), np.int64)
        for at in range(0, len(self.texts), 500):
            count += np.bincount(np.concatenate(self.texts[at:at + 500]), minlength=len(count))
        order = np.argsort(-count, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        self.texts = [place[t] for t in self.texts]
        own = list(self.numbers)
        return [own[i] for i in order.tolist()]


def _name(words: list[str], place: int) -> bytes:
    """Of the task's block number ``place``, in both scans of the input."""
    digest = hashlib.blake2b("\0".join(words).encode("utf-8", "surrogatepass"), digest_size=12).digest()
    return digest + TaskContext.get().partitionId().to_bytes(4, "big") + place.to_bytes(4, "big")


def _squeeze(numbers: np.ndarray) -> bytes:
    """Numbers by byte planes: the high bytes are mostly 0."""
    return zlib.compress(np.ascontiguousarray(
        numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _spread(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(
        np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _blocks(batches: Iterator[pa.RecordBatch], splitter: Splitter) -> Iterator[tuple[Numbered, list]]:
    block, kept = Numbered(), []
    for b in batches:
        kept.append(b.column("doc_id"))
        for at in range(0, b.num_rows, 500):
            for text in b.column("text").slice(at, 500).to_pylist():
                block.add(text, splitter)
        if block.chars >= BLOCK_CHARS:
            yield block, kept
            block, kept = Numbered(), []
    if kept:
        yield block, kept
    del block, kept
    pa.default_memory_pool().release_unused()


def block_words(docs: DataFrame, vocabulary) -> DataFrame:
    """``block, number, word``: the distinct words of every block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, (block, _) in enumerate(_blocks(batches, _splitter(vocabulary.value))):
            words = block.words()
            name = _name(words, place)
            for at in range(0, len(words), 20_000):
                some = words[at:at + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(some), pa.binary()),
                     pa.array(range(at, at + len(some)), pa.int32()), pa.array(some, pa.string())],
                    names=["block", "number", "word"])

    return docs.select("doc_id", "text").mapInArrow(run, "block binary, number int, word string")


def block_texts(docs: DataFrame, vocabulary) -> DataFrame:
    """``block, doc_id, numbers``: every row of ``docs`` as word numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for place, (block, ids) in enumerate(_blocks(batches, _splitter(vocabulary.value))):
            name, at = _name(block.words(), place), 0
            for part in ids:
                texts = block.texts[at:at + len(part)]
                at += len(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(part), pa.binary()), part,
                     pa.array([_squeeze(t) for t in texts], pa.binary())],
                    names=["block", "doc_id", "numbers"])

    own = docs.select("doc_id", "text")
    kind = own.schema["doc_id"].dataType.simpleString()
    return own.mapInArrow(run, f"block binary, doc_id {kind}, numbers binary")


def encoded_words(words: DataFrame, vocabulary) -> DataFrame:
    """``block, numbers, sizes, ids``: the words of each block with their ids, a
    few packed rows a block, from ``words(block, number, word)``.

    All rows of a word are in one partition, next to one another: it is encoded
    once and kept no longer than its rows last.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        special = {w: [i] for w, i in _splitter(vocabulary.value).specials.items()}
        model = _word_model(vocabulary.value)
        held: dict[bytes, list[tuple]] = {}
        count, last = 0, (None, [])

        def out() -> pa.RecordBatch:
            rows = []
            for name, parts in held.items():
                numbers, sizes, ids = (np.concatenate(x) for x in zip(*parts))
                rows.append((name, _squeeze(numbers), _squeeze(sizes), _squeeze(ids)))
            return pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*rows)],
                                              names=["block", "numbers", "sizes", "ids"])

        for b in batches:
            if not b.num_rows:
                continue
            words = pc.dictionary_encode(b.column("word"))
            distinct = words.dictionary.to_pylist()
            ids = [e.ids for e in model.encode_batch(
                [w for w in distinct if w != last[0] and w not in special], add_special_tokens=False)]
            fresh = iter(ids)
            coded = [last[1] if w == last[0] else special[w] if w in special else next(fresh)
                     for w in distinct]
            last = (distinct[-1], coded[-1])
            size = np.array([len(c) for c in coded], np.int64)
            flat = np.array([i for c in coded for i in c], np.int64)
            start = np.cumsum(size) - size
            which = words.indices.to_numpy()
            blocks = pc.dictionary_encode(b.column("block"))
            owner, number = blocks.indices.to_numpy(), b.column("number").to_numpy()
            order = np.argsort(owner, kind="stable")
            edges = np.searchsorted(owner[order], np.arange(len(blocks.dictionary) + 1))
            for k, name in enumerate(blocks.dictionary.to_pylist()):
                at = order[edges[k]:edges[k + 1]]
                n = size[which[at]]
                where = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(
                    start[which[at]], n)
                held.setdefault(name, []).append((number[at], n, flat[where]))
            count += b.num_rows
            if count >= 1_000_000:
                yield out()
                held, count = {}, 0
        if held:
            yield out()

    return (words.repartition("word").sortWithinPartitions("word")
            .select("block", "number", "word")
            .mapInArrow(run, "block binary, numbers binary, sizes binary, ids binary"))


def piece_names(vocabulary: str) -> dict[int, str]:
    """The piece of every id."""
    spec = json.loads(vocabulary)
    return {**{i: t for t, i in spec["model"]["vocab"].items()},
            **{t["id"]: t["content"] for t in spec["added_tokens"]}}


def pieces(spark: SparkSession, vocabulary: str) -> DataFrame:
    """``id, piece``: one row for each id; as many as the tokenizer has."""
    names = piece_names(vocabulary)
    return spark.createDataFrame(
        pa.table({"id": pa.array(list(names), pa.int32()), "piece": pa.array(list(names.values()))}))


class _Coded:
    """The encoded words of one block, by number, joined to their pieces."""

    def __init__(self, table: pa.Table, names: dict[int, str]):
        numbers, sizes, ids = [], [], []
        for r in table.to_pylist():
            numbers.append(_spread(r["numbers"]))
            sizes.append(_spread(r["sizes"]))
            ids.append(_spread(r["ids"]))
        none = np.zeros(0, np.int64)
        numbers, sizes, ids = (np.concatenate([*x, none]).astype(np.int64) for x in (numbers, sizes, ids))
        top = int(numbers.max()) + 1 if len(numbers) else 0
        self.at, self.size = np.zeros(top, np.int64), np.full(top, -1, np.int64)
        self.at[numbers], self.size[numbers] = np.cumsum(sizes) - sizes, sizes
        self.ids = ids.astype("<u4")
        shown = list(map(names.__getitem__, ids.tolist()))
        self.decoded = [" ".join(shown[a:a + n]) if n > 1 else shown[a] if n == 1 else ""
                        for a, n in zip(self.at.tolist(), self.size.tolist())]

    def text(self, numbers: np.ndarray) -> tuple[np.ndarray, str]:
        if len(numbers) and (numbers.max() >= len(self.size) or (self.size[numbers] < 0).any()):
            raise RuntimeError("a block's words and texts don't match")
        n = self.size[numbers]
        start = np.cumsum(n) - n
        where = np.arange(int(n.sum())) - np.repeat(start, n) + np.repeat(self.at[numbers], n)
        shown = numbers if n.all() else numbers[n > 0]
        return self.ids[where], " ".join(map(self.decoded.__getitem__, shown.tolist()))


def _assemble(docs: DataFrame, vocabulary: str, of, names: str) -> DataFrame:
    """``doc_id`` and the columns ``names`` that ``of(ids, decoded)`` returns."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    check_form(json.loads(vocabulary))
    coded = encoded_words(block_words(docs, shared), shared)
    texts = block_texts(docs, shared)
    kind = texts.schema["doc_id"].dataType.simpleString()
    fields = [x.split(" ")[0] for x in names.split(", ")]

    def put(left: pa.Table, right: pa.Table) -> pa.Table:
        names = per_process(_key(shared.value, "pieces"), lambda: piece_names(shared.value))
        words = _Coded(right, names)
        rows = [of(*words.text(_spread(x.as_py()).astype(np.int64))) for x in left.column("numbers")]
        return pa.table([left.column("doc_id"), *(pa.array(c) for c in zip(*rows))],
                        names=["doc_id", *fields])

    return (texts.groupBy("block").cogroup(coded.groupBy("block"))
            .applyInArrow(put, f"doc_id {kind}, {names}"))


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, ids, decoded``: token ids of every row of ``docs`` (``doc_id,
    text``; further columns are ignored) under the tokenizer of the JSON text
    ``vocabulary``, without added special tokens, and the text they decode to.

    A null or empty text has no ids and decodes to the empty text; repeated rows
    are each returned; an empty table gives an empty result.
    """
    return _assemble(docs, vocabulary, lambda ids, text: (ids.astype(np.int32), text),
                     "ids array<int>, decoded string")


def digests(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of :func:`encode`'s ids
    (little-endian, 32 bits) and decoded texts (UTF-8), without moving them."""
    def of(ids: np.ndarray, text: str) -> tuple[int, str, str]:
        return (len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(),
                hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())

    return _assemble(docs, vocabulary, of,
                     "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def decode(rows: DataFrame, vocabulary: str) -> DataFrame:
    """``doc_id, decoded`` of every row of ``rows(doc_id, ids)``: ids joined to
    their pieces.  Rows that repeat a doc_id and its ids are one result."""
    spark: SparkSession = rows.sparkSession
    each = (rows.select("doc_id", "ids").distinct()
            .select("doc_id", F.xxhash64("ids").alias("h"), F.posexplode_outer("ids").alias("at", "id")))
    parts = F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "piece"))))
    return (each.join(F.broadcast(pieces(spark, vocabulary)), "id", "left").groupBy("doc_id", "h").agg(parts.alias("p"))
            .select("doc_id", F.array_join("p.piece", " ").alias("decoded")))
