"""Problem 9: reading level of each document from vocabulary coverage and sentence complexity."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage, spread

#: Share of a sentence's words that the smallest vocabulary must cover.
COVER = 0.65
#: Words ranked in all, shared out equally among the languages, and words of a class ranking; this bounds what is broadcast. A word behind them has the rank after the last.
WORDS = 262_144
CLASS_WORDS = 262_144
#: Labelled documents used for the calibration at most, chosen by hash. All other statistics are over all documents.
LABELLED = 20_000
#: Languages told apart, the most frequent ones of the ``lang`` column, and the labelled documents of both kinds that a language needs
#: for class vocabularies of its own; below that it uses those of all languages together.
LANGUAGES = 32
LANGUAGE_LABELS = 5
#: Every sentence longer than this is read in stretches of so many words, with or without its end mark; the length feature ends here.
STRETCH = 30
#: Characters of text that a worker turns into arrays at once.
CHARACTERS = 2_000_000
#: Levels from here count as demanding.
DEMANDING = 3.5
FEATURES = ("everyday", "learned", "corpus", "length")

#: Ends a sentence or paragraph in a list of words.
_END = "\n"
_SPACES = str.maketrans(dict.fromkeys(",\"()[]{}*<>'-\t\r", " "))
_LEVELS = ("WARNING", "ERROR", "INFO", "DEBUG", "CRITICAL")
_TRIM = "\u00ab\u00bb\u201c\u201d\u201e\u2026\u2013\u2014\u00bf\u00a1.,;:!?`"


def _is_prose(line: str) -> bool:
    """False for table rows, headings, log lines and comma-separated records."""
    first = line[0]
    if first in "|#":
        return False
    if first == "[" and "]" in line[:24] and line[1:2].isdigit():
        return False
    if "=" in line and line.startswith(_LEVELS):
        return False
    return " " in line or line.count(",") < 3


def _is_list(paragraph: str) -> bool:
    """True for captions and tag lists: three or more short phrases between commas and no end of a sentence."""
    parts = paragraph.split(",")
    return len(parts) > 2 and not any(c in paragraph for c in ".!?") and all(len(x) <= 45 for x in parts)


def prose_words(text: str | None) -> list[str]:
    """Lower-case words of the running prose with a line feed after each sentence and paragraph.

    Left out: front matter, fenced code, headings, table rows, log lines, comma-separated records, captions and tag lists; inside sentences
    anything with a digit or underscore. Single line breaks (scanned pages) join, bullets are sentences. A fence that is never closed ends with its paragraph.
    """
    if not text:
        return []
    lines = text.split("\n")
    if lines[0].strip() == "---":
        for i in range(1, len(lines)):
            if lines[i].strip() == "---":
                lines = lines[i + 1 :]
                break
    fences = sum(x.startswith("```") for x in lines) if "```" in text else 0
    paragraphs: list[str] = []
    held: list[str] = []
    fenced = False

    def flush() -> None:
        if held:
            joined = " ".join(held)
            if not _is_list(joined):
                paragraphs.append(joined)
            held.clear()

    for line in lines:
        line = line.strip()
        if line.startswith("```"):
            fenced = not fenced
            fences -= 1
            flush()
        elif not line:
            flush()
            fenced = fenced and fences > 0
        elif not fenced and _is_prose(line):
            if line.startswith(("- ", "* ")):
                flush()
            if held and line[0].islower() and held[-1].endswith("-") and held[-1][-2:-1].isalpha():
                held[-1] = held[-1][:-1] + line  # a word cut at the end of a scanned line
            else:
                held.append(line)
    flush()
    if not paragraphs:
        return []
    t = (" \n ".join(paragraphs) + " ").lower()
    for mark in (". ", "! ", "? ", "; "):
        t = t.replace(mark, " \n ")
    # A line feed stays a word of its own: the text is cut at single blanks.
    return [w for w in t.translate(_SPACES).split(" ") if w]


def _known(word: str) -> str:
    """The word if it is one, else what is left of it without outer punctuation, else ``""``."""
    if word.isalpha():
        return word
    word = word.strip(_TRIM)
    return word if word.isalpha() else ""


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, word, n) of a partition, counted before anything is shuffled."""
    counts: dict[str, Counter] = {}

    def drain() -> pa.RecordBatch:
        rows = [(lang, w, n) for lang, c in counts.items() for k, n in c.items() if k != _END and (w := _known(k))]
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.string(), pa.string(), pa.int64()))], names=["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
            counts.setdefault(lang or "", Counter()).update(prose_words(text))
        if sum(map(len, counts.values())) > 1_000_000:
            yield drain()
    yield drain()


class Vocabulary:
    """Ranks of all known words by language, and the features of texts."""

    def __init__(self, corpus: list[tuple[str, dict[str, int]]], languages: list[str]):
        """``corpus`` holds (word, count per language), the most frequent word first."""
        self.languages = languages or [""]
        self.index = {w: i for i, (w, _) in enumerate(corpus)}
        self.index[_END] = -2
        n = len(corpus)
        by = np.array([[c.get(x, 0) for x in self.languages] for _, c in corpus], dtype=float).reshape(n, len(self.languages))
        # How much a word speaks for each language; unknown words say nothing.
        self.votes = np.vstack([np.log((by + 0.5) / (by.sum(0) + 0.5 * max(n, 1))), np.zeros(len(self.languages))])
        self.tables = np.empty((3, len(self.languages), n + 1), dtype=np.int32)
        self.sizes = np.empty((3, len(self.languages)))
        for i in range(len(self.languages)):
            used = [j for j in np.argsort(-by[:, i], kind="stable") if by[j, i] > 0]
            self._set(2, i, {j: r + 1 for r, j in enumerate(used)})
            self._set(0, i, {})
            self._set(1, i, {})

    def _set(self, table: int, language: int, ranks: dict[int, int]) -> None:
        last = len(ranks) + 1
        self.tables[table, language] = last
        for j, r in ranks.items():
            self.tables[table, language, j] = r
        self.sizes[table, language] = last

    def add_classes(self, ranks: dict[tuple[str, bool], dict[str, int]]) -> None:
        """Class vocabularies (language, demanding) -> word -> rank; words new to the corpus ranks are added."""
        new = list(dict.fromkeys(w for r in ranks.values() for w in r if w not in self.index))
        self.index |= {w: len(self.votes) - 1 + i for i, w in enumerate(new)}
        # The last row and column stand for unknown words.
        self.votes = np.vstack([self.votes, np.repeat(self.votes[-1:], len(new), axis=0)])
        self.tables = np.concatenate([self.tables, np.repeat(self.tables[:, :, -1:], len(new), axis=2)], axis=2)
        for i, language in enumerate(self.languages):
            for hard in (False, True):
                own = ranks.get((language, hard), ranks.get(("*", hard), {}))
                self._set(int(hard), i, {self.index[w]: r for w, r in own.items()})

    def _ids(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        get, parts, owner = self.index.get, [], []
        for i, t in enumerate(texts):
            tokens = prose_words(t)
            ids = np.fromiter((get(w, -1) for w in tokens), dtype=np.int64, count=len(tokens))
            for j in np.flatnonzero(ids == -1):
                word = _known(tokens[j])
                ids[j] = get(word, -1) if word else -3
            parts += [ids, np.array([-2])]
            owner.append(np.full(len(tokens) + 1, i))
        return (np.concatenate(parts), np.concatenate(owner)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64))

    def languages_of(self, ids: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
        """Number of the language its words speak for most, per text."""
        real = ids >= -1
        return np.stack([np.bincount(text[real], self.votes[ids[real], i], count) for i in range(len(self.languages))], axis=1).argmax(1) if count else np.empty(0, np.int64)

    def features(self, texts: list[str | None], cover: float = COVER) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Rows of FEATURES per sentence, its words, its text's number; and the language of each text.

        A coverage feature is the logarithm of the smallest rank R, as a share of the vocabulary, such that its first R words cover ``cover`` of the sentence.
        A batch is worked off in runs of about CHARACTERS, so that memory does not follow the length of its texts.
        """
        parts, start, size = [], 0, 0
        for i, t in enumerate(texts):
            size += len(t or "")
            if size >= CHARACTERS or i == len(texts) - 1:
                rows, length, text, language = self._features(texts[start : i + 1], cover)
                parts.append((rows, length, text + start, language))
                start, size = i + 1, 0
        if not parts:
            return self._features([], cover)
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _features(self, texts: list[str | None], cover: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        ids, text = self._ids(texts)
        language = self.languages_of(ids, text, len(texts))
        sentence = np.cumsum(ids == -2)
        word = ids >= -1
        ids, text, sentence = ids[word], text[word], sentence[word]
        if not len(ids):
            return np.empty((0, len(FEATURES))), np.empty(0, np.int64), np.empty(0, np.int64), language
        first = np.r_[True, sentence[1:] != sentence[:-1]]
        begin = np.maximum.accumulate(np.where(first, np.arange(len(ids)), 0))
        first |= (np.arange(len(ids)) - begin) % STRETCH == 0
        unit = np.cumsum(first) - 1
        start = np.flatnonzero(first)
        length = np.diff(np.r_[start, len(ids)])
        at = start + np.maximum(np.ceil(cover * length - 1e-9).astype(np.int64) - 1, 0)
        bits = np.int64(21)
        columns = []
        for table, sizes in zip(self.tables, self.sizes):
            ordered = np.sort((unit << bits) | table[language[text], ids].astype(np.int64))
            columns.append(np.log((ordered[at] & ((1 << bits) - 1)) / sizes[language[text[start]]]))
        columns.append(np.log(length))
        return np.column_stack(columns), length, text[start], language


def corpus_vocabulary(documents: DataFrame, words: int = WORDS, most: int = LANGUAGES) -> Vocabulary:
    """Word frequencies in the prose of all documents, by the language they claim.

    The ``most`` languages with the most words are told apart; each keeps as many of its most frequent words as its equal part of ``words`` allows, words of equal frequency all or
    none, so that no language takes another's room. Where the parts end is read off the number of words per frequency; the driver gets ``words`` rows at most.
    """
    lang = F.coalesce(F.lower(F.substring(F.trim("lang"), 1, 2)), F.lit(""))
    counts = documents.select(lang.alias("lang"), "text").mapInArrow(_count_words, "lang string, word string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n"))
    counts = cut_lineage(counts)
    claimed = counts.groupBy("lang").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "lang").limit(most + 1).collect()
    languages = [r["lang"] for r in claimed if r["lang"]][:most]
    # All other claims, and none, are one more part.
    part = F.when(F.col("lang").isin(*languages), F.col("lang")).otherwise("") if languages else F.lit("")
    placed = counts.groupBy("word", part.alias("part")).agg(F.sum("n").alias("n"))
    down = Window.partitionBy("part").orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, 0)
    by_count = placed.groupBy("part", "n").agg(F.count(F.lit(1)).alias("m")).withColumn("m", F.sum("m").over(down))
    ends = by_count.filter(F.col("m") <= words // (len(languages) + 1)).groupBy("part").agg(F.min("n").alias("least"))
    kept = placed.join(F.broadcast(ends), "part").filter("n >= least").select("word").distinct()
    by_word = counts.join(kept, "word").groupBy("word").agg(F.sum("n").alias("n"), F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"))
    rows = by_word.orderBy(F.desc("n"), "word").collect()
    return Vocabulary([(r["word"], r["by"]) for r in rows], languages)


def _labelled_words(vocabulary) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            rows = []
            texts = batch.column("text").to_pylist()
            language = v.languages_of(*v._ids(texts), len(texts))
            for t, level, x in zip(texts, batch.column("level").to_pylist(), language):
                counts = Counter(w for k in prose_words(t) if k != _END and (w := _known(k)))
                n = sum(counts.values())
                rows += [(v.languages[x], level >= DEMANDING, w, k / n, i == 0) for i, (w, k) in enumerate(counts.items())]
            types = (pa.string(), pa.bool_(), pa.string(), pa.float64(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names=["lang", "hard", "word", "w", "head"])

    return run


def class_ranks(labelled: DataFrame, vocabulary, words: int = CLASS_WORDS) -> dict[tuple[str, bool], dict[str, int]]:
    """Ranks by frequency in the labelled everyday (below DEMANDING) and demanding documents of each language, and of all (``*``).

    Each document weighs the same. The labelled documents are bounded, and so is what is ranked.
    """
    tokens = cut_lineage(labelled.mapInArrow(_labelled_words(vocabulary), "lang string, hard boolean, word string, w double, head boolean"))
    enough = tokens.filter("head").groupBy("lang").agg(F.least(F.count_if("hard"), F.count_if(~F.col("hard"))).alias("n")).filter(F.col("n") >= LANGUAGE_LABELS).select("lang")
    both = tokens.join(F.broadcast(enough), "lang").unionByName(tokens.withColumn("lang", F.lit("*")))
    weights = both.groupBy("lang", "hard", "word").agg(F.round(F.sum("w"), 9).alias("w"))
    order = Window.partitionBy("lang", "hard").orderBy(F.desc("w"), "word")
    out: dict[tuple[str, bool], dict[str, int]] = {}
    for r in weights.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= words).select("lang", "hard", "word", "rank").collect():
        out.setdefault((r["lang"], r["hard"]), {})[r["word"]] = r["rank"]
    return out


def _document_features(vocabulary) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            count = batch.num_rows
            rows, length, text, _ = v.features(batch.column("text").to_pylist())
            n = np.bincount(text, length, count)
            mean = [np.bincount(text, rows[:, i] * length, count) / np.maximum(n, 1) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([batch.column("level"), *map(pa.array, mean), pa.array(n.astype("int64"))], names=["level", *FEATURES, "words"])

    return run


def calibrate(rows: DataFrame) -> np.ndarray | None:
    """Least-squares weights of FEATURES and a constant for ``level``, from sums of products computed in SQL; None without labels."""
    names = [*FEATURES, "one"]
    table = rows.filter("words > 0").withColumn("one", F.lit(1.0))
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(names) for b in [*names[i:], "level"]]
    got = table.agg(F.count(F.lit(1)).alias("n"), *products).first()
    if not got["n"]:
        return None
    square = np.array([[got[f"{min(a, b, key=names.index)}_{max(a, b, key=names.index)}"] for b in names] for a in names])
    # A trace of ridge keeps the system solvable where a feature is constant.
    return np.linalg.solve(square + np.eye(len(names)) * 1e-5 * got["n"], np.array([got[f"{a}_level"] for a in names]))


def label_levels(labels: DataFrame) -> DataFrame:
    """Mean valid level per document; of a rater's repeated entries the latest counts, entries outside 1..5 are none."""
    valid = labels.filter(F.col("reading_level").between(1, 5) & F.col("doc_id").isNotNull())
    last = valid.groupBy("doc_id", "rater_id").agg(F.max_by("reading_level", F.struct("rated_at", "reading_level")).alias("x"))
    return last.groupBy("doc_id").agg(F.avg("x").alias("level"))


def median_level(levels: np.ndarray, length: np.ndarray, text: np.ndarray, count: int) -> np.ndarray:
    """Median of the sentences' levels per text, each sentence weighing its words; NaN without sentences."""
    out = np.full(count, math.nan)
    if len(levels):
        order = np.lexsort((levels, text))
        own, of = levels[order], text[order]
        words = np.bincount(text, length, count)
        run = np.cumsum(length[order]) - np.r_[0, np.cumsum(words)][of]
        past = run * 2 >= words[of]
        heads = np.flatnonzero(past & np.r_[True, ~past[:-1] | (of[1:] != of[:-1])])
        out[of[heads]] = own[heads]
    return out


def reading_levels(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> DataFrame:
    """``doc_id``, ``words`` of prose and the estimated ``level`` (1 to 5) of every document.

    Each sentence is described by the smallest frequency-ranked vocabulary of its language that covers a fixed share of its words, for three
    rankings (the whole corpus, the labelled everyday and the labelled demanding documents), and by its length; a least-squares
    calibration against the labels turns that into a level. The document's level is the median over its words, so that the greater
    part of its prose counts. The language is the one the words speak for; the ``lang`` column, often wrong, only counts in bulk.
    Documents without prose, and all documents where nothing is labelled, have a null level. A document with a null doc_id
    gets its row under null; repeated rows get a row each.
    """
    context = documents.sparkSession.sparkContext
    documents = spread(documents.select("doc_id", "lang", "text"))
    known = label_levels(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    sample = cut_lineage(documents.select("doc_id", "text").join(F.broadcast(known), "doc_id").select("level", "text"))
    ranks = corpus_vocabulary(documents)
    ranks.add_classes(class_ranks(sample, context.broadcast(ranks)))
    vocabulary = context.broadcast(ranks)
    weights = calibrate(sample.mapInArrow(_document_features(vocabulary), "level double, " + ", ".join(f"{f} double" for f in FEATURES) + ", words bigint"))

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary.value
        for batch in batches:
            count = batch.num_rows
            rows, length, text, _ = v.features(batch.column("text").to_pylist())
            words = np.bincount(text, length, count).astype("int64")
            level = np.full(count, math.nan)
            if weights is not None and len(rows):
                level = median_level(np.clip(rows @ weights[:-1] + weights[-1], 1.0, 5.0), length, text, count)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(words), pa.array(level, mask=np.isnan(level))], names=["doc_id", "words", "level"])

    return documents.mapInArrow(estimate, "doc_id bigint, words bigint, level double")
