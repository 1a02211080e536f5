"""Language identification by cross-parsing entropy.

For every language a suffix automaton holds all substrings of some labelled text.
A new text is parsed from left to right into longest matches: each phrase is the
longest piece that occurs in the language's text. Few phrases mean that the text
could have been cut from that language. With n characters of labelled text, a
phrase costs log2(n) bits; the language with the fewest bits a character wins.
"""

from __future__ import annotations

import json
import math
import re
import unicodedata
import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelcast.llm.common import BOOL, DOUBLE, LONG, STRING, map_rows, resident, schema, whole_text
from panelcast.session import ship_package

#: The bounded sample a language is learned from: so many rows, so many characters of each.
SAMPLE_ROWS, SAMPLE_CHARS = 80, 600
UNKNOWN = "und"
_GAPS = re.compile(r"[\W\d_]+")
#: Number signs that a regular expression takes for word signs though they are no letters
#: (fractions, circled and Roman numerals; all lie below U+20000).
_SIGNS = "".join(c for c in map(chr, range(0x80, 0x20000)) if unicodedata.category(c) in ("No", "Nl"))
_SIGN_GAPS = re.compile(rf"[ {re.escape(_SIGNS)}]+")


def normalise(text: str) -> str:
    """Lower case, everything between letters one blank."""
    line = _GAPS.sub(" ", text.lower())
    # few texts have such signs, and a pattern that names them all is slow
    if line.isascii() or line.replace(" ", "").isalpha():
        return line
    return _SIGN_GAPS.sub(" ", line)


class SuffixAutomaton:
    """All substrings of a text; a state is the dict of its transitions."""

    def __init__(self, text: str):
        step, link, length = [{}], [-1], [0]
        last = 0
        for c in text:
            new = len(step)
            step.append({})
            link.append(0)
            length.append(length[last] + 1)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = new
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[q] == length[p] + 1:
                    link[new] = q
                else:
                    twin = len(step)
                    step.append(dict(step[q]))
                    link.append(link[q])
                    length.append(length[p] + 1)
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        for state in step:
            for c, to in state.items():
                state[c] = step[to]
        self.root = step[0]
        self.bits = math.log2(max(2, len(text)))

    def phrases(self, text: str) -> int:
        """Longest-match phrases of the text; an unseen character is a phrase."""
        n, root = 0, self.root
        state = root
        for c in text:
            to = state.get(c)
            if to is None:
                if state is not root:
                    n += 1
                to = root.get(c)
                if to is None:
                    n += 1
                    to = root
            state = to
        return n + (state is not root)


class Identifier:
    def __init__(self, samples: dict[str, str]):
        self.models = {lang: SuffixAutomaton(text) for lang, text in sorted(samples.items()) if text.strip()}

    def predict(self, text: str) -> tuple[str, float]:
        """(language, score); the score is how much dearer the runner-up is, 0 to 1."""
        line = normalise(text)
        if not self.models or not line.strip():
            return UNKNOWN, 0.0
        costs = sorted((m.phrases(line) * m.bits, lang) for lang, m in self.models.items())
        if len(costs) == 1 or costs[1][0] == 0:
            return costs[0][1], 1.0 if len(costs) == 1 else 0.0
        return costs[0][1], 1.0 - costs[0][0] / costs[1][0]


def identifier(model: str) -> Identifier:
    """One set of automata for each model and worker process."""
    return resident(("language", zlib.crc32(model.encode()), len(model)), lambda: Identifier(json.loads(model)))


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text is a multiple of 5; a missing id is the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> str:
    """The model: for each language, excerpts of ``chars`` characters from ``rows`` of its
    documents, chosen by a hash of doc_id and text among those that aren't held out.

    All labelled rows are counted first; only rows whose hash falls under a bound
    made from the count are ranked, so no language's rows meet in one task.
    """
    src = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")) & whole_text().rlike(r"\p{L}"))
    src = src.select(F.col("lang").cast("string").alias("lang"), F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    src = src.withColumn("h", F.xxhash64("doc_id", "text"))
    # one number for each language; the model holds a text for each as well
    counts = {r["lang"]: r["n"] for r in src.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not counts:
        return "{}"
    shares = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, (4.0 * rows + 50) / n))])
    near = src.filter(F.col("h").cast("double") < shares[F.col("lang")] * (2.0 ** 64) - 2.0 ** 63)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "doc_id", "text"))
    room = F.greatest(F.lit(1), F.char_length("text") - chars + 1)
    cut = F.col("text").substr((1 + F.pmod("h", room.cast("long"))).cast("int"), F.lit(chars))
    picked = near.withColumn("r", rank).filter(F.col("r") <= rows).select("lang", "r", cut.alias("cut")).collect()
    texts: dict[str, list[tuple[int, str]]] = {}
    for row in picked:
        texts.setdefault(row["lang"], []).append((row["r"], row["cut"]))
    # a line feed never occurs in normalised text, so no match runs from one excerpt into the next
    return json.dumps({k: "\n".join(normalise(c) for _, c in sorted(v)) for k, v in sorted(texts.items())})


def identify(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per row of ``docs``, from the text alone.

    Null and empty texts and texts without letters are ``und`` with score 0, and so
    is everything if nothing was learned. Ties go to the language first in the
    alphabet. Repeated rows each keep a row; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), whole_text().alias("text"))

    def make():
        known = identifier(shared.value)
        return lambda batch: [(i, h, *known.predict(t)) for i, h, t in zip(*batch.values())]

    return map_rows(src, schema(doc_id=LONG, held_out=BOOL, lang_pred=STRING, score=DOUBLE), make)


def keep_identified(docs: DataFrame, model: str) -> DataFrame:
    """The rows of ``docs`` with an identified language, all columns as they are."""
    ship_package(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        known = identifier(shared.value)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([known.predict(t.as_py() or "")[0] != UNKNOWN for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
