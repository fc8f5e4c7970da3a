"""Language identification by cross-parsing entropy.

For every language, a suffix automaton of a bounded sample of its labelled text
accepts exactly the substrings of that sample.  A text is parsed against each
automaton into the longest phrases that occur in the sample.  ``phrases *
log2(size of the sample) / length`` estimates the cross entropy (Ziv and Merhav);
the language that needs fewest normalised phrases wins.

The automata are built on the driver from the sample, whose size is a
parameter, and broadcast.  Parsing is one pass over the documents without a
shuffle: many blocks of text advance through an automaton together, one symbol
a step, as numpy gathers.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duetto.llm.common import fold_of, fresh

#: Bound of the training sample: symbols in all languages together, and in one.
SAMPLE_SYMBOLS, LANGUAGE_SYMBOLS = 131_072, 16_384
#: Whole texts are dealt into pieces of so many code points, each of which may be drawn.
PIECE = 2_048
#: Expected number of pieces drawn for a language.
LANGUAGE_DOCS = 64
#: A language of which fewer were drawn gives so many of its pieces, if it has them.
LEAST_DOCS = 8
#: So many languages are learned, those with the most pieces.
MAX_LANGUAGES = 256
BLOCK = 1024            # texts are parsed in blocks of so many symbols
LANES = 4096            # blocks that advance together
UNDETERMINED = "und"
ABOVE_CHANCE = 1.05     # a score that is no better than this times chance tells nothing
SCORE_SCALE = 1.0       # bits a symbol; the score is a softmax of -entropy / scale

GAP, OTHER, FIRST = 0, 1, 2     # symbols: between letters; a letter that no sample has
WIDTH = 64                      # symbols of an automaton's row; those above have keys
_SYMBOL = 21                    # bits of a symbol in a key
_COUNT, _STATE = 28, (1 << 28) - 1


class Model(NamedTuple):
    languages: list[str]
    symbols: bytes          # of every code point, compressed
    tables: list[tuple]     # by language: the parts of its Automaton, compressed
    bits: list[float]       # by language: log2 of the sample's size


class Automaton(NamedTuple):
    """Entries of (state, symbol): the next state, and above bit 28 how many
    phrases end at this step.  The frequent symbols, those below ``WIDTH``, have a
    flat table; the transitions of all others are found by their sorted keys."""

    table: np.ndarray       # by state and symbol below WIDTH
    keys: np.ndarray        # state << _SYMBOL | symbol
    entries: np.ndarray     # of the keys
    fail: np.ndarray        # by symbol: the entry without a transition; the last is for absent symbols

    def rare(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """Entries of symbols that are not below ``WIDTH``."""
        out = self.fail[np.minimum(symbol, len(self.fail) - 1)]
        out = np.where(state == 0, 1 << _COUNT, out)
        if len(self.keys):
            key = state.astype(np.int64) << _SYMBOL | symbol
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            out = np.where(self.keys[at] == key, self.entries[at], out)
        return out


def _fold(c: str) -> str:
    """A letter in lower case, if that is one letter."""
    low = c.lower()
    return low if len(low) == 1 else c


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points after one another, and the end of each text."""
    texts = [unicodedata.normalize("NFC", t) for t in texts]
    flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return flat, np.cumsum([len(t) for t in texts], dtype=np.int64)


def to_symbols(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, gaps joined to one, and the end of each text."""
    flat, ends = _code_points(texts)
    sym = table[flat]
    keep = np.ones(len(sym), dtype=bool)
    if len(sym):
        keep[1:] = (sym[1:] != GAP) | (sym[:-1] != GAP)
        starts = np.concatenate([[0], ends[:-1]])
        keep[starts[starts < len(sym)]] = True
    kept = np.concatenate([[0], np.cumsum(keep)])
    return sym[keep], kept[ends]


def symbol_table(texts: list[str]) -> np.ndarray:
    """The symbol of every code point: every letter of ``texts`` has its own, the
    frequent ones the smallest; letters of either case are one symbol."""
    seen = Counter(_fold(c) for t in texts for c in unicodedata.normalize("NFC", t) if c.isalpha())
    order = sorted(seen, key=lambda c: (-seen[c], c))
    known = {c: FIRST + i for i, c in enumerate(order)}
    table = np.zeros(0x110000, dtype=np.int32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            table[c] = known.get(_fold(ch), OTHER)
    return table


def automaton(symbols: np.ndarray) -> Automaton:
    """The suffix automaton of ``symbols``.

    A symbol that goes on within the sample ends none.  One that does not ends
    the phrase so far and starts the next; one that the sample lacks is a phrase
    of its own as well.
    """
    nxt, link, length, last = [{}], [-1], [0], 0
    for c in symbols.tolist():
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p >= 0:
            q = nxt[p][c]
            if length[p] + 1 == length[q]:
                link[cur] = q
            else:
                twin = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and nxt[p].get(c) == q:
                    nxt[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    top = max(WIDTH, int(symbols.max(initial=0)) + 1)
    root = np.zeros(top, dtype=np.int32)
    fail = np.full(top + 1, 2 << _COUNT, dtype=np.int32)    # the phrase, and the symbol alone
    for c, q in nxt[0].items():
        root[c], fail[c] = q, q | 1 << _COUNT
    table = np.tile(fail[:WIDTH], (len(nxt), 1))
    table[0] = np.where(root[:WIDTH] > 0, root[:WIDTH], 1 << _COUNT)
    rare = []
    for s, go in enumerate(nxt):
        for c, q in go.items():
            if c < WIDTH:
                table[s, c] = q
            else:
                rare.append((s << _SYMBOL | c, q))
    keys, entries = np.array(sorted(rare), dtype=np.int64).reshape(-1, 2).T
    return Automaton(table.ravel(), np.ascontiguousarray(keys), entries.astype(np.int32), fail)


def phrase_counts(sym: np.ndarray, ends: np.ndarray, tables: list[Automaton]) -> np.ndarray:
    """Phrases of every text (rows) against every automaton (columns)."""
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    blocks = -(-(ends - starts) // BLOCK)
    owner = np.repeat(np.arange(len(ends)), blocks)
    first = np.cumsum(blocks) - blocks
    begin = starts[owner] + (np.arange(len(owner)) - first[owner]) * BLOCK
    size = np.minimum(begin + BLOCK, ends[owner]) - begin
    order = np.argsort(-size, kind="stable")
    out = np.zeros((len(ends), len(tables)), dtype=np.int64)
    for at in range(0, len(order), LANES):
        lane = order[at:at + LANES]
        sizes = size[lane]
        steps = np.arange(sizes[0])[:, None]
        where = np.minimum(begin[lane][None, :] + steps, len(sym) - 1)
        grid = sym[where].astype(np.int32)
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
        seldom = (grid >= WIDTH).any(axis=1)
        frequent = np.minimum(grid, WIDTH - 1)
        for k, parser in enumerate(tables):
            table = parser.table
            state = np.zeros(len(lane), dtype=np.int32)
            count = np.zeros(len(lane), dtype=np.int32)
            for t in range(int(sizes[0])):
                n = active[t]
                e = table.take((state[:n] << 6) + frequent[t, :n])
                if seldom[t]:
                    at = np.flatnonzero(grid[t, :n] >= WIDTH)
                    e[at] = parser.rare(state[at], grid[t, at])
                count[:n] += e >> _COUNT
                state[:n] = e & _STATE
            out[:, k] += np.bincount(owner[lane], weights=count + (state != 0),
                                     minlength=len(ends)).astype(np.int64)
    return out


def fit(samples: dict[str, list[str]]) -> Model:
    """A model of the given texts by language."""
    table = symbol_table([t for texts in samples.values() for t in texts])
    room = max(1024, min(LANGUAGE_SYMBOLS, SAMPLE_SYMBOLS // max(1, len(samples))))
    languages, tables, bits = [], [], []
    for lang in sorted(samples):
        sym, ends = to_symbols(samples[lang], table)
        parts, left = [], room
        for s, e in zip(np.concatenate([[0], ends[:-1]]), ends):
            if parts and e - s > left:      # whole ones only, and one at least
                continue
            parts.append(np.append(sym[s:e], np.int32(GAP)))
            left -= e - s
        text = np.concatenate(parts)
        languages.append(lang)
        tables.append(tuple(zlib.compress(part.tobytes(), 1) for part in automaton(text)))
        bits.append(float(np.log2(max(2, len(text)))))
    return Model(languages, zlib.compress(table.tobytes(), 1), tables, bits)


def training_sample(docs: DataFrame) -> dict[str, list[str]]:
    """About ``LANGUAGE_DOCS`` pieces of the texts of each language, from rows that
    are not held out and have a letter, by a hash of id, text and place.

    Pieces of all places of all texts are drawn alike.  Copies of a row are one.
    Only the ``MAX_LANGUAGES`` languages with the most pieces are drawn, so that the
    sample is bounded however many values ``lang`` has.
    """
    usable = docs.select("lang", "text", F.xxhash64("doc_id", "text").alias("th"),
                         fold_of(F.col("doc_id")).alias("held")).filter(
        "not held and lang is not null and text rlike '\\\\p{L}'")
    count = F.ceil(F.char_length("text") / PIECE)
    # As many rows as languages that are learned.
    sizes = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.sum(count).alias("n"))
             .orderBy(F.desc("n"), "lang").limit(MAX_LANGUAGES).collect()}
    if not sizes:
        return {}
    pieces = usable.withColumn("at", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))))
    h = F.xxhash64("th", "at")
    one = ["lang", h.alias("h"), F.substring("text", F.col("at") * PIECE + 1, F.lit(PIECE)).alias("t")]
    million = 1_000_000
    limits = docs.sparkSession.createDataFrame(
        [(lang, int(million * min(1.0, LANGUAGE_DOCS / n)) + 1) for lang, n in sorted(sizes.items())],
        "lang string, most int")
    drawn = (pieces.join(F.broadcast(limits), "lang").filter(F.pmod(h, F.lit(million)) < F.col("most"))
             .select(*one).groupBy("lang", "h").agg(F.first("t").alias("t")))
    texts: dict[str, list[tuple]] = {}
    for r in drawn.collect():
        texts.setdefault(r["lang"], []).append((r["h"], r["t"]))
    few = [lang for lang, n in sorted(sizes.items()) if len(texts.get(lang, [])) < min(n, LEAST_DOCS)]
    if few:
        order = Window.partitionBy("lang").orderBy("h")
        some = docs.sparkSession.createDataFrame([(lang,) for lang in few], "lang string")
        keys = (pieces.join(F.broadcast(some), "lang").select("lang", h.alias("h")).distinct()
                .withColumn("n", F.row_number().over(order)).filter(F.col("n") <= LEAST_DOCS).select("lang", "h"))
        # LEAST_DOCS rows a language at most.
        first = (pieces.withColumn("h", h).join(F.broadcast(keys), ["lang", "h"])
                 .select("lang", "h", one[2]).groupBy("lang", "h").agg(F.first("t").alias("t")))
        texts |= dict.fromkeys(few, ())
        for r in first.collect():
            texts[r["lang"]] = [*texts[r["lang"]], (r["h"], r["t"])]
    return {lang: [t for _, t in sorted(rows)] for lang, rows in texts.items() if rows}


def predict(docs: DataFrame, model: Model, name: str = "language") -> DataFrame:
    """``docs`` with a struct column ``name``: ``lang_pred, score, bits``.

    ``bits`` is the estimated cross entropy of the winner in bits a symbol.  A
    text that is null or has no letter is ``und`` with score 0.  Equal entropies
    go to the first language in order.  Only the text is read.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(tuple(model))

    @F.pandas_udf("lang_pred string, score double, bits double")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = Model(*shared.value)
        table = np.frombuffer(zlib.decompress(m.symbols), dtype=np.int32)
        kinds = (np.int32, np.int64, np.int32, np.int32)
        tables = [Automaton(*(np.frombuffer(zlib.decompress(x), dtype=d) for x, d in zip(t, kinds)))
                  for t in m.tables]
        names = np.array([*m.languages, UNDETERMINED], dtype=object)
        bits = np.array(m.bits)

        def some(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            sym, ends = to_symbols(texts, table)
            n = np.diff(np.concatenate([[0], ends]))
            letters = np.concatenate([[0], np.cumsum(sym != GAP)])
            has = (letters[ends] - letters[ends - n]) > 0
            if not len(sym) or not tables:
                return (np.where(has, 0.0, np.nan), np.zeros(len(texts)),
                        np.full(len(texts), len(names) - 1))
            h = phrase_counts(sym, ends, tables) * bits / np.maximum(n, 1)[:, None]
            best = h.argmin(axis=1)
            low = h[np.arange(len(h)), best]
            score = 1.0 / np.exp((low[:, None] - h) / SCORE_SCALE).sum(axis=1)
            return (np.where(has, low, np.nan), np.where(has, score, 0.0),
                    np.where(has, best, len(names) - 1))

        for series in batches:
            texts = ["" if t is None else t for t in series.tolist()]
            parts, at = [], 0
            while at < len(texts):      # some megabytes at a time, one text at least
                to, room = at + 1, 4_000_000 - len(texts[at])
                while to < len(texts) and len(texts[to]) <= room:
                    room -= len(texts[to])
                    to += 1
                parts.append(some(texts[at:to]))
                at = to
            low, score, best = (np.concatenate(x) for x in zip(*parts)) if parts else ([], [], [])
            yield pd.DataFrame({"lang_pred": names[np.asarray(best, dtype=np.int64)],
                                "score": score, "bits": low})

    return docs.withColumn(name, judge(F.col("text")))


def identify(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, bits`` for every row of ``docs``
    (``doc_id, text, lang``; further columns are ignored).

    The model is fitted to rows that are not held out, see :func:`training_sample`;
    any number of values of ``lang`` will do.  Null and empty texts are ``und``; very
    long ones are parsed whole, block by block.  Languages that need equally many
    phrases are ranked by name.  Without any labelled text every prediction is
    ``und``.  Repeated rows are each returned; an empty table gives an empty result.
    """
    model = fit(training_sample(docs))
    own = predict(docs.select("doc_id", "text"), model)
    return own.select("doc_id", fold_of(F.col("doc_id")).alias("held_out"),
                      F.col("language.lang_pred").alias("lang_pred"),
                      F.col("language.score").alias("score"), F.col("language.bits").alias("bits"))


def least_score(languages: int) -> float:
    """The score that tells a language from chance among so many."""
    return min(1.0, ABOVE_CHANCE / max(1, languages))


def keep_identified(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language is known: predicted, and with a score
    of :func:`least_score` at least.  All columns stay as they are, whatever their
    names.  Null and empty texts go; long ones are judged whole; repeated rows stay
    or go together; an empty table stays empty."""
    name, model = fresh(docs, "language"), fit(training_sample(docs))
    judged = predict(docs, model, name)
    return judged.filter((F.col(f"{name}.lang_pred") != UNDETERMINED)
                         & (F.col(f"{name}.score") >= least_score(len(model.languages)))).drop(name)
