"""Language of texts and of the spans of mixed texts.

A text is cut into words: runs of letters of one script, single characters where a script
writes no spaces. The script narrows the languages that a word can be of to those that were
seen to use it. Within these, a word's score per language is the log likelihood of its character
n-grams under the language's counts, relative to the best. A Viterbi path over the words, on
which each change of language costs a penalty, labels the words; runs of one label are spans.
The language of a text is the one whose spans hold most of its letters.

N-grams are counted in Spark over a bounded sample of texts per language; the counts kept are
of bounded size and sent to the tasks. A path is worked out in blocks of words: blocks of all
texts of a batch go through numpy together, once for the best way from each entry to each
exit language, then, with entries known, once for the path itself.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harvestlake.llm.common import small_batches, stage, stop_if_missing, text_of

#: Bound of the sample of texts per language that n-grams are counted in; labelling has no bound.
MAX_TEXTS = 1500
#: Most frequent n-grams kept per language.
MAX_NGRAMS = 20_000
#: Characters of an n-gram, the marks at a word's ends included.
SIZES = (3,)
#: What a change of language costs, and the most that one word counts against a language.
SWITCH = 12.0
MOST = 8.0
#: Words in one block of the path.
BLOCK = 64
#: Words that go through numpy at a time.
BATCH_WORDS = 1 << 18
#: Words whose scores a task remembers.
REMEMBERED = 400_000
#: Share of a language's letters that a script must hold for the language to use it.
SCRIPT_SHARE = 0.005
UNKNOWN = "und"

#: Unicode blocks of scripts, and whether a single character is a word.
SCRIPTS = [
    ("latin", "A-Za-z\u00AA\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u02B8\u1E00-\u1EFF", False),
    ("greek", "\u0370-\u03FF\u1F00-\u1FFF", False),
    ("cyrillic", "\u0400-\u052F\u1C80-\u1C8F\u2DE0-\u2DFF\uA640-\uA69F", False),
    ("armenian", "\u0530-\u058F", False),
    ("hebrew", "\u0590-\u05FF", False),
    ("arabic", "\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF\uFB50-\uFDFF\uFE70-\uFEFF", False),
    ("devanagari", "\u0900-\u097F", False),
    ("bengali", "\u0980-\u09FF", False),
    ("tamil", "\u0B80-\u0BFF", False),
    ("telugu", "\u0C00-\u0C7F", False),
    ("thai", "\u0E00-\u0E7F", True),
    ("georgian", "\u10A0-\u10FF", False),
    ("hangul", "\u1100-\u11FF\u3130-\u318F\uAC00-\uD7AF", False),
    ("kana", "\u3040-\u30FF\u31F0-\u31FF", True),
    ("han", "\u2E80-\u2FDF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF\U00020000-\U0003FFFF", True),
]
_LETTER = r"[^\W\d_]"
# The ranges of Latin hold letters only; in the others digits and signs are left out.
_WORDS = re.compile(
    "|".join(
        f"[{ranges}]+" if name == "latin" else f"(?:(?=[{ranges}]){_LETTER}){'' if single else '+'}"
        for name, ranges, single in SCRIPTS
    )
    + f"|{_LETTER}"
)
_ONE_LETTER = re.compile(_LETTER)
_RANGES = [(name, re.compile(f"[{ranges}]")) for name, ranges, _ in SCRIPTS]


def script_of(word: str) -> str:
    """Script of a word's first letter; letters outside the table are of script ``other``."""
    return next((name for name, ranges in _RANGES if ranges.match(word)), "other")


def ngrams(word: str) -> list[str]:
    marked = f"<{word}>"
    return [marked[i : i + n] for n in SIZES for i in range(len(marked) - n + 1)]


@dataclass
class LanguageModel:
    """Languages in order of name, their n-gram scores and the scripts they use."""

    languages: list[str] = field(default_factory=list)
    #: n-gram to its row in ``logs``
    grams: dict[str, int] = field(default_factory=dict)
    #: log likelihoods (n-grams, languages); the last row, zeros, is that of unknown n-grams
    logs: np.ndarray = field(default_factory=lambda: np.zeros((1, 0)))
    #: script to the numbers of the languages that use it
    scripts: dict[str, list[int]] = field(default_factory=dict)
    #: language that is most frequent among the rows learned from
    usual: int = 0
    switch: float = SWITCH
    #: tells models apart in worker processes
    key: str = field(default_factory=lambda: uuid.uuid4().hex)

    def score_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words, languages): 0 for a word's best language, down to ``-MOST``; and which words are known.

        Languages that don't use the word's script get ``-MOST``. If no language uses it, the
        word isn't known and says nothing: all 0.
        """
        unknown = len(self.logs) - 1
        rows, starts, scripts = [], [], []
        first: dict[str, int] = {}
        names = [*(name for name, _ in _RANGES), "other"]
        users = np.zeros((len(names), len(self.languages)), dtype=bool)
        for script, own in self.scripts.items():
            users[names.index(script), own] = True
        get = self.grams.get
        for word in words:
            lowered = word.lower()
            starts.append(len(rows))
            rows += [get(gram, unknown) for gram in ngrams(lowered)]
            script = first.get(lowered[0])
            if script is None:
                script = first[lowered[0]] = names.index(script_of(lowered))
            scripts.append(script)
        total = np.add.reduceat(self.logs[rows], starts, axis=0)
        allowed = users[scripts]
        known = allowed.any(axis=1)
        total = np.where(allowed, total, -np.inf)
        total[~known] = 0.0
        return np.maximum(total - total.max(axis=1, keepdims=True), -MOST), known


def best_path(scores: list[np.ndarray], switch: float, block: int = BLOCK) -> list[np.ndarray]:
    """The label of each word on the best path of each text.

    ``scores`` has one array (words, languages) per text. A path's value is the sum of its
    words' scores less ``switch`` for each change of label. Of equally good ways one that stays
    counts first, then the lowest label; the value is always the greatest.
    """
    n = scores[0].shape[1] if scores else 0
    spans = [-(-len(s) // block) for s in scores]
    if not sum(spans):
        return [np.zeros(0, dtype=np.int64) for _ in scores]
    # Blocks of all texts, filled up with words that say nothing, through which a path just stays.
    cells = np.zeros((sum(spans) * block, n))
    at = 0
    for s, count in zip(scores, spans, strict=True):
        cells[at : at + len(s)] = s
        at += count * block
    steps = cells.reshape(-1, block, n).transpose(1, 0, 2)

    # Best value from each entry label to each exit label of a block.
    ways = np.where(np.eye(n, dtype=bool), 0.0, -switch)[None, :, :] + steps[0][:, None, :]
    for words in steps[1:]:
        ways = np.maximum(ways, ways.max(axis=2, keepdims=True) - switch) + words[:, None, :]

    # From block to block of a text; a text may begin with any label.
    came = np.zeros((len(ways), n), dtype=np.int64)
    exits = np.zeros(len(ways), dtype=np.int64)
    at = 0
    for count in spans:
        value = np.zeros(n)
        for k in range(at, at + count):
            total = value[:, None] + ways[k]
            # Staying first: a block that can be crossed with its entry label is.
            came[k] = np.where(np.diag(total) >= total.max(axis=0), np.arange(n), total.argmax(axis=0))
            value = total.max(axis=0)
        if count:
            last = int(value.argmax())
            for k in range(at + count - 1, at - 1, -1):
                exits[k] = last
                last = int(came[k, last])
        at += count
    entries = came[np.arange(len(ways)), exits]

    # The path inside the blocks, entries and exits known.
    value = np.full((len(ways), n), -switch)
    value[np.arange(len(ways)), entries] = 0.0
    value += steps[0]
    back = np.empty((block, len(ways), n), dtype=np.int16)
    stay = np.arange(n, dtype=np.int16)
    for t in range(1, block):
        top = value.argmax(axis=1)
        moved = value[np.arange(len(ways)), top][:, None] - switch
        back[t] = np.where(value >= moved, stay, top[:, None])
        value = np.maximum(value, moved) + steps[t]
    labels = np.empty((len(ways), block), dtype=np.int64)
    labels[:, -1] = exits
    for t in range(block - 1, 0, -1):
        labels[:, t - 1] = back[t, np.arange(len(ways)), labels[:, t]]
    flat = labels.reshape(-1)
    out, at = [], 0
    for s, count in zip(scores, spans, strict=True):
        out.append(flat[at : at + len(s)])
        at += count * block
    return out


class Labeller:
    """Labels texts with a model; remembers the scores of words it has met."""

    def __init__(self, model: LanguageModel, spans: bool = True):
        self.model, self.spans = model, spans
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        #: words met since the last path, not scored yet
        self.fresh: list[str] = []
        self.table = np.zeros((0, len(self.model.languages)))
        self.known = np.zeros(0, dtype=bool)
        self.lengths = np.zeros(0, dtype=np.int64)

    def _number(self, word: str) -> int:
        number = self.numbers.get(word)
        if number is None:
            number = self.numbers[word] = len(self.numbers)
            self.fresh.append(word)
        return number

    def _score_fresh(self) -> None:
        for at in range(0, len(self.fresh), 20_000):
            words = self.fresh[at : at + 20_000]
            scores, known = self.model.score_words(words)
            # Superscripts and the like match as letters but are none.
            lengths = np.array([len(w) if w.isalpha() else sum(map(str.isalpha, w)) for w in words])
            self.table = np.concatenate([self.table, scores])
            self.known = np.concatenate([self.known, known])
            self.lengths = np.concatenate([self.lengths, lengths])
        self.fresh = []

    def label(self, texts: list[str]) -> list[tuple[str, float, list]]:
        """(language, score, spans) of each text."""
        out, held, size = [], [], 0
        for text in texts:
            words = _WORDS.findall(text)
            if len(self.numbers) > REMEMBERED:
                out += self._finish(held)
                held, size = [], 0
                self._forget()
            numbers, number = self.numbers, self._number
            held.append((text, [numbers[w] if w in numbers else number(w) for w in words]))
            size += len(words)
            if size >= BATCH_WORDS:
                out += self._finish(held)
                held, size = [], 0
        return out + self._finish(held)

    def _finish(self, held: list[tuple[str, list[int]]]) -> list[tuple[str, float, list]]:
        languages = self.model.languages
        if not languages:
            return [(UNKNOWN, 0.0, []) for _ in held]
        self._score_fresh()
        table, known, lengths = self.table, self.known, self.lengths
        numbers = [np.array(n, dtype=np.int64) for _, n in held]
        paths = best_path([table[n] for n in numbers], self.model.switch)
        out = []
        for (text, _), own, path in zip(held, numbers, paths, strict=True):
            if not lengths[own].any():
                out.append((UNKNOWN, 0.0, []))
                continue
            letters = np.bincount(path, np.where(known[own], lengths[own], 0), len(languages))
            if letters.any():
                best = int(np.lexsort((-table[own].sum(axis=0), -letters))[0])
                share = float(letters[best] / lengths[own].sum())
            else:
                best, share = self.model.usual, 0.0
            out.append((languages[best], share, self._spans(text, path) if self.spans else []))
        return out

    def _spans(self, text: str, path: np.ndarray) -> list[tuple[int, int, str]]:
        """(begin, end, language) in code points: from a span's first word to the end of its last."""
        turns = np.flatnonzero(np.diff(path, prepend=-1))
        if len(turns) == 1:  # nearly all texts: no need to find every word again
            end = next(i for i in range(len(text), 0, -1) if _ONE_LETTER.match(text, i - 1))
            return [(_ONE_LETTER.search(text).start(), end, self.model.languages[path[0]])]
        ends = np.append(turns[1:], len(path)) - 1
        wanted = set(turns.tolist()) | set(ends.tolist())
        places = {i: m.span() for i, m in enumerate(_WORDS.finditer(text)) if i in wanted}
        return [
            (places[int(a)][0], places[int(z)][1], self.model.languages[path[a]]) for a, z in zip(turns, ends, strict=True)
        ]


#: The labeller of this worker process, which its tasks share: words are scored once, not per task.
_labeller: Labeller | None = None


def labeller_of(model: LanguageModel, spans: bool) -> Labeller:
    global _labeller
    if _labeller is None or (_labeller.model.key, _labeller.spans) != (model.key, spans):
        _labeller = Labeller(model, spans)
    return _labeller


def _count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """N-gram counts and letters per script (key ``\\tscript``) of each language in this task."""
    counts: dict[str, Counter] = {}
    for frame in frames:
        for language, text in zip(frame["lang"], frame["text"], strict=True):
            own = counts.setdefault(language, Counter())
            for word, n in Counter(_WORDS.findall(text.lower())).items():
                own["\t" + script_of(word)] += n * len(word)
                # A word that one text repeats shouldn't outweigh the language.
                for gram in ngrams(word):
                    own[gram] += min(n, 3)
    for language, own in counts.items():
        items = list(own.items())
        for at in range(0, len(items), 50_000):
            part = items[at : at + 50_000]
            yield pd.DataFrame({"lang": language, "gram": [g for g, _ in part], "n": [n for _, n in part]})


def fit_languages(
    docs: DataFrame, held_out: Column | None = None, max_texts: int = MAX_TEXTS, max_ngrams: int = MAX_NGRAMS,
    switch: float = SWITCH,
) -> LanguageModel:
    """Learn from ``docs`` (doc_id, text, lang).

    Rows whose id makes ``held_out`` true, or whose id, lang or text is null, take no part. Per
    language at most ``max_texts`` texts are counted, those of the smallest hashes of id and
    text (equal rows count once), and at most ``max_ngrams`` n-grams are kept, the most frequent
    (ties by text). Without any row the model knows no language.
    """
    stop_if_missing(docs, "doc_id", "text", "lang")
    trains = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    if held_out is not None:
        trains = trains & ~held_out
    rows = docs.where(trains).select("doc_id", F.col("lang").cast("string").alias("lang"), text_of().alias("text"))
    small_batches(docs.sparkSession)
    per_language = rows.groupBy("lang").agg(F.count("*").alias("rows")).orderBy("lang")
    sizes = {r["lang"]: r["rows"] for r in per_language.collect()}
    if not sizes:
        return LanguageModel()
    # A share per language that gives half as many again as wanted, then the smallest hashes.
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 1.5 * max_texts / n))])
    hashed = rows.withColumn("hash", F.xxhash64("doc_id", "text"))
    below = F.col("hash").cast("double") < share[F.col("lang")] * float(1 << 64) - float(1 << 63)
    few = hashed.where(below | (share[F.col("lang")] >= 1.0)).dropDuplicates(["lang", "hash"])
    few = few.withColumn("k", F.row_number().over(Window.partitionBy("lang").orderBy("hash"))).where(F.col("k") <= max_texts)
    sample = stage(few.select("lang", "text"), "language-sample")
    counted = stage(
        sample.repartition(8).mapInPandas(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n")),
        "language-counts",
    )
    kept = counted.where(~F.col("gram").startswith("\t")).withColumn(
        "k", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    ).where(F.col("k") <= max_ngrams)
    model = LanguageModel(sorted(sizes), switch=switch)
    number = {lang: i for i, lang in enumerate(model.languages)}
    model.usual = number[max(sorted(sizes), key=lambda lang: sizes[lang])]

    letters: dict[str, dict[str, int]] = {}
    for r in counted.where(F.col("gram").startswith("\t")).collect():
        letters.setdefault(r["lang"], {})[r["gram"][1:]] = r["n"]
    for lang, own in sorted(letters.items()):
        for script, n in own.items():
            if script != "other" and n >= SCRIPT_SHARE * sum(own.values()):
                model.scripts.setdefault(script, []).append(number[lang])

    found = kept.select("lang", "gram", "n").toPandas()
    for gram in found["gram"]:
        model.grams.setdefault(gram, len(model.grams))
    counts = np.zeros((len(model.grams) + 1, len(number)))
    counts[[model.grams[g] for g in found["gram"]], [number[lang] for lang in found["lang"]]] = found["n"]
    # Each size of n-gram is a distribution of its own, smoothed by a half; unknown ones say nothing.
    of_size = np.array([*map(len, model.grams), 0])
    model.logs = np.zeros_like(counts)
    for size in np.unique(of_size[:-1]):
        own = counts[of_size == size] + 0.5
        # A word's n-grams overlap, so each counts in part.
        model.logs[of_size == size] = np.log(own / own.sum(axis=0)) / (len(SIZES) + 1)
    return model


def label_documents(
    docs: DataFrame, model: LanguageModel, text: str = "text", found: str = "language", spans: bool = True
) -> DataFrame:
    """``docs`` with a struct ``found``: ``lang``, ``score`` and ``spans`` of each whole text.

    ``score`` is the share of the text's letters in spans of ``lang``. ``spans`` lists (begin,
    end, lang) in code points, in order, without overlap. Null texts, texts without a letter, and
    all texts if the model knows no language, get ``und`` with score 0 and no spans. A text
    whose letters are all of scripts that no learned language uses gets the most frequent
    language with score 0. Equal texts get equal results; other columns stay as they are.
    """
    spark = docs.sparkSession
    small_batches(spark)
    return docs.withColumn(found, _column(spark, model, text_of(text), spans))


def _column(spark: SparkSession, model: LanguageModel, text: Column, spans: bool) -> Column:
    # Of bounded size: max_ngrams n-grams per language.
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double, spans array<struct<begin:int,end:int,lang:string>>")
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = labeller_of(shared.value, spans)
        for texts in batches:
            told = labeller.label(texts.tolist())
            yield pd.DataFrame(
                {
                    "lang": [t[0] for t in told],
                    "score": [t[1] for t in told],
                    "spans": [[{"begin": b, "end": e, "lang": lang} for b, e, lang in t[2]] for t in told],
                }
            )

    return label(text)
