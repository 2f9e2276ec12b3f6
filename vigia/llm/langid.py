"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of
labelled text.  A document is parsed greedily against each automaton: a phrase
is the longest run of symbols that occurs in the language's sample.  The number
of phrases, times log2 of the sample's length, over the document's length is
the cross-parsing estimate of bits a symbol; the language needing fewest wins.

Texts are lower-cased and every run of non-letters counts as one space.  Whole
texts are parsed; phrases end at every ``BLOCK`` symbols, so that the blocks of
many documents are parsed side by side as numpy arrays.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rows import attach

#: The sample: rows of a language, characters of a row (documented bounds of the fit).
SAMPLE_ROWS, SAMPLE_CHARS = 64, 512
#: Symbols with a column of the transition table; steps by rarer ones are a sorted list.
SYMBOLS = 48
BLOCK = 1024
_LANES = 2048


def code_points(text: str) -> np.ndarray:
    """Lower-cased code points, each run of non-letters as one space (none at
    the start)."""
    text = text.lower()
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    if not len(points):
        return points
    low = points < 128
    letter = np.zeros(len(points), dtype=bool)
    letter[low] = (points[low] >= 97) & (points[low] <= 122)
    if not low.all():
        some, back = np.unique(points[~low], return_inverse=True)
        letter[~low] = np.array([chr(p).isalpha() for p in some])[back]
    points = np.where(letter, points, 32)
    again = ~letter
    again[1:] &= ~letter[:-1]
    again[0] = not letter[0]
    return points[~again]


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def automaton_edges(symbols: list[int]) -> list[dict[int, int]]:
    """Steps of each state of the automaton whose paths from state 0 spell
    exactly the substrings of ``symbols``."""
    links, lengths, edges = [-1], [0], [{}]
    last = 0
    for c in symbols:
        new = len(edges)
        edges.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = new
            p = links[p]
        if p >= 0:
            q = edges[p][c]
            if lengths[q] == lengths[p] + 1:
                links[new] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                lengths.append(lengths[p] + 1)
                links.append(links[q])
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = links[p]
                links[q] = links[new] = copy
        last = new
    return edges


def suffix_automaton(symbols: list[int], width: int) -> np.ndarray:
    """The automaton's steps as a table (states x width, -1: none)."""
    edges = automaton_edges(symbols)
    table = np.full((len(edges), width), -1, dtype=np.int32)
    for state, out in enumerate(edges):
        for c, to in out.items():
            table[state, c] = to
    return table


@dataclass
class Model:
    """Automata of all languages in one table; ``roots`` are their first states."""

    languages: list[str]
    alphabet: np.ndarray  # sorted code points
    number: np.ndarray  # their symbols, commonest first; len(alphabet): any other
    table: np.ndarray  # steps by the commonest symbols; the last column has none
    roots: np.ndarray
    bits: np.ndarray  # log2 of the sample's length
    rare: np.ndarray  # sorted: state * len(alphabet) + symbol of the steps by other symbols
    rare_to: np.ndarray

    def symbols(self, points: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.alphabet, points), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == points, self.number[at], len(self.alphabet))

    def follow(self, state: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The states (languages x lanes) that a symbol of each lane leads to, -1: none."""
        width = self.table.shape[1]
        to = self.table.ravel().take(state * width + np.minimum(symbol, width - 1))
        if len(self.rare):
            at = np.flatnonzero((symbol >= width - 1) & (symbol < len(self.alphabet)))
            if len(at):
                key = np.broadcast_to(state, to.shape)[:, at] * len(self.alphabet) + symbol[at]
                i = np.minimum(np.searchsorted(self.rare, key), len(self.rare) - 1)
                to[:, at] = np.where(self.rare[i] == key, self.rare_to[i], -1)
        return to

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language."""
        found = np.zeros((len(texts), len(self.languages)), dtype=np.int64)
        owner, blocks = [], []
        for i, points in enumerate(texts):
            symbols = self.symbols(points)
            for at in range(0, len(symbols), BLOCK):
                owner.append(i)
                blocks.append(symbols[at:at + BLOCK])
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
        for at in range(0, len(order), _LANES):
            lanes = order[at:at + _LANES]
            lengths = np.array([len(blocks[i]) for i in lanes])
            grid = np.zeros((lengths[0], len(lanes)), dtype=np.int64)
            for k, i in enumerate(lanes):
                grid[:lengths[k], k] = blocks[i]
            running = np.searchsorted(-lengths, -np.arange(lengths[0]), side="left")  # lanes longer than step
            roots = self.roots[:, None]
            state = np.repeat(roots, len(lanes), axis=1)
            count = np.zeros(state.shape, dtype=np.int64)
            for step in range(lengths[0]):
                m = running[step]
                symbol = grid[step, :m]
                to = self.follow(state[:, :m], symbol)
                miss = to < 0
                # a phrase starts after a miss, and where none is open (at the root)
                count[:, :m] += miss | (state[:, :m] == roots)
                if miss.any():
                    fresh = self.follow(roots, symbol)
                    # a symbol that the sample lacks is a phrase of its own and leaves none open
                    to = np.where(miss, np.where(fresh < 0, roots, fresh), to)
                state[:, :m] = to
            np.add.at(found, np.array([owner[i] for i in lanes]), count.T)
        return found

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of each text; ``und`` and 0 where the text is
        null or has no letter, or no language was learned.  Score: how much
        less than the second language the first needs, 0 to 1 (1 if there is
        only one).  Ties go to the language first in the alphabet."""
        names, scores = ["und"] * len(texts), [0.0] * len(texts)
        at = [i for i, t in enumerate(texts) if has_letter(t)] if self.languages else []
        if at:
            cost = self.phrases([code_points(texts[i]) for i in at]) * self.bits
            for i, c in zip(at, cost, strict=True):
                best = int(np.argmin(c))
                others = np.delete(c, best)
                names[i] = self.languages[best]
                scores[i] = float(min(1.0, max(0.0, 1 - c[best] / others.min()))) if len(others) else 1.0
        return names, scores


def build(samples: dict[str, list[str]]) -> Model:
    languages = sorted(samples)
    points = {name: [code_points(t) for t in samples[name]] for name in languages}
    seen = Counter({32: 1})
    for texts in points.values():
        for t in texts:
            seen.update(t.tolist())
    common = np.array([p for p, _ in sorted(seen.items(), key=lambda x: (-x[1], x[0]))], dtype=np.uint32)
    number = np.argsort(common)
    width = min(len(common), SYMBOLS) + 1
    model = Model(languages, common[number], number, np.zeros((1, width), dtype=np.int32), np.zeros(0, np.int64),
                  np.zeros(0), np.zeros(0, np.int64), np.zeros(0, np.int64))
    tables, roots, bits, states, rare = [], [], [], 0, []
    for name in languages:
        symbols = np.concatenate([np.append(model.symbols(t), model.symbols(np.array([32], np.uint32)))
                                  for t in points[name]] or [np.zeros(0, np.int64)])
        edges = automaton_edges(symbols.tolist())
        table = np.full((len(edges), width), -1, dtype=np.int32)
        for state, out in enumerate(edges):
            for c, to in out.items():
                if c < width - 1:
                    table[state, c] = to + states
                else:
                    rare.append(((state + states) * len(common) + c, to + states))
        tables.append(table)
        roots.append(states)
        bits.append(np.log2(max(2, len(symbols))))
        states += len(table)
    if tables:
        model.table = np.concatenate(tables)
        pairs = np.array(sorted(rare), dtype=np.int64).reshape(-1, 2)
        model.rare, model.rare_to = pairs[:, 0].copy(), pairs[:, 1].copy()
        model.roots, model.bits = np.array(roots, dtype=np.int64), np.array(bits)
    return model


def held_out(id_col: str) -> F.Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> Model:
    """Learn from at most ``rows`` labelled documents of each language, at most
    ``chars`` characters each: of the rows whose crc32(id) mod 3 is not 1 and
    whose language is not null, the one of smallest hash in each of ``rows``
    hash buckets."""
    key = F.xxhash64(F.col(f"`{id_col}`"))
    text = F.col(f"`{text_col}`")
    learn = (docs.where(F.col(f"`{lang_col}`").isNotNull() & F.col(f"`{id_col}`").isNotNull()
                        & ~held_out(id_col) & text.rlike(r"\p{L}"))
             .select(F.col(f"`{lang_col}`").cast("string").alias("lang"), key.alias("key"), text.alias("text")))
    picked = (learn.groupBy("lang", F.pmod("key", F.lit(rows)).alias("bucket")).agg(F.min("key").alias("key"))
              .select("lang", "key"))
    names = picked.collect()  # bounded: rows of each language
    samples: dict[str, list[str]] = {r["lang"]: [] for r in names}
    wanted = docs.sparkSession.createDataFrame([tuple(r) for r in names], "lang string, key long")
    chosen = (learn.join(F.broadcast(wanted), ["lang", "key"])
              .select("lang", F.substring("text", 1, chars).alias("text")).distinct())
    for r in sorted(chosen.collect()):  # bounded: rows x characters
        samples[r["lang"]].append(r["text"])
    return build(samples)


def identify(docs: DataFrame, model: Model, text_col: str = "text", out_col: str = "language") -> DataFrame:
    """``docs`` with ``out_col`` struct(lang string, score double).  Each row
    by itself: repeated rows and empty tables need nothing special, other
    columns pass through, a clashing ``out_col`` raises."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def make():
        def predict(texts: list) -> list:
            return [{"lang": n, "score": s} for n, s in zip(*shared.value.predict(texts), strict=True)]
        return predict

    return attach(docs, text_col, out_col, "struct<lang:string,score:double>", make, rows=1024)


def predictions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    model = fit(docs, id_col, text_col, lang_col)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return (identify(rows, model)
            .select("doc_id", held_out("doc_id").alias("held_out"), F.col("language.lang").alias("lang_pred"),
                    F.col("language.score").alias("score")))
