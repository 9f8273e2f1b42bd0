"""Toxicity scores by gradient-boosted trees over dense features, calibrated by isotonic regression.

Features of a whole text: densities of two lexicons (given insults, and words and word stems
learned from labels: languages inflect their insults), how often a second-person word stands near a hit, shares of capitals and shouted
words, punctuation rates, and obfuscation rates (look-alike characters, signs inside words,
spelled-out letters). No label, language, source or id is a feature.

The learning rows are dealt into folds by hash. The trees see each row with the lexicon of the
other folds, and a fifth of the rows of each label is kept from them for the calibration, so neither is fitted
to what it is applied to; scoring uses the lexicon of all folds. Equal texts with equal labels
count once a fold for the lexicon. At most about ``TRAIN_ROWS`` labelled ids are used, chosen by
hash, up to half of them of the rarer label (a documented bound), and the learned lexicon has at most ``LEARNED_WORDS``
words and stems (the size of the model); every document is scored.

Null and empty texts have all-zero features and get the score of those. With labels of one
class only, or none, all scores are 0; with a single row of a class the trees stay uncalibrated. Repeated labels of
a document count once, toxic if one is; of texts with one id, one is learned from. Null labels are not used. Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from homeledger.llm.common import slices
from homeledger.session import cut_lineage

TRAIN_ROWS = 20_000
LEARNED_WORDS = 1000
LEAST_DOCS = 3
FOLDS = 4
HELD = 2  # of five parts, the one for the calibration: a label's second row is in it
LEAST_Z = 3.0
STEMS = (4, 5)  # letters of a stem; the lexicon writes it with a star
NEAR = 5  # words between a second-person word and a hit
TREES, DEPTH, STEP = 20, 3, 0.2
THRESHOLD = 0.7

# A starting list of common insults in the corpus languages.
INSULTS = frozenset("""
idiot idiots moron morons stupid dumb dumbass fool fools loser losers scum trash garbage pathetic worthless disgusting
clown clowns jerk jerks creep filth imbecile cretin bastard bitch asshole shit fuck fucking retard pig vermin
connard connasse salaud salope crétin imbécile débile ordure merde abruti
arschloch blödmann dummkopf scheiße trottel schwachkopf abschaum vollidiot wichser
idiota estúpido estúpida imbécil gilipollas cabrón pendejo mierda basura tonto
""".split())
SECOND_PERSON = frozenset("you your yours yourself u ur tu te toi vous ton ta tes votre vos du dich dir dein deine ihr euch sie ihnen "
                          "tú ti usted ustedes vosotros su sus".split())
LOOKS = str.maketrans("01345789@$!|+€", "oieastbgasiite")
WORD = re.compile(r"\S+")
SIGNS = re.compile(r"[!?]")
REPEATED = re.compile(r"([^\w\s])\1+")
SPELLED = re.compile(r"(?<![^\W_])(?:[^\W\d_][ .*_-]){2,}[^\W\d_](?![^\W_])")
EDGES = "".join(c for c in map(chr, range(33, 256)) if not c.isalnum()) + "«»“”„’‘…–—¿¡"
FEATURES = (
    "given_hits", "given_density", "learned_hits", "learned_density", "learned_weight", "strongest", "kinds", "masked_hits",
    "masked_density", "second_person", "near_hits", "near_density", "capitals", "shouted", "marks", "punctuation", "repeated",
    "mixed_words", "inner_signs", "spelled")


class Lexicon:
    """Learned weights of words and stems, and a quick test for words that may be in a lexicon."""

    def __init__(self, learned: dict[str, float]):
        self.learned = learned
        self.heads = {w.rstrip("*")[:STEMS[0]] for w in (*learned, *INSULTS)}

    def weight(self, word: str) -> float:
        """0 for a word that is not in the learned lexicon."""
        found = self.learned.get(word)
        for n in reversed(STEMS):
            if found is None and len(word) > n:
                found = self.learned.get(word[:n] + "*")
        return found or 0.0


def features(text: str | None, lexicon: Lexicon) -> list[float]:
    """In the order of ``FEATURES``."""
    text = text or ""
    raw = text.split()
    n = len(raw) or 1
    words = [w.strip(EDGES) for w in text.lower().split()]
    heads, head = lexicon.heads, STEMS[0]
    near_lexicon = [i for i, w in enumerate(words) if w[:head] in heads]
    given = [i for i in near_lexicon if words[i] in INSULTS]
    hits = [(i, x) for i in near_lexicon if (x := lexicon.weight(words[i]))]
    known = {*given, *(i for i, _ in hits)}
    masked, mixed, inner = [], 0, 0
    for i, w in enumerate(words):
        if w.isalpha() or not w or w.isdigit():
            continue
        mixed += any(c.isdigit() for c in w) and any(c.isalpha() for c in w)
        inner += any(not c.isalnum() and c not in "'’-" for c in w)
        bare = "".join(c for c in w.translate(LOOKS) if c.isalpha())
        if i not in known and (bare in INSULTS or lexicon.weight(bare)):
            masked.append(i)
    spelled = SPELLED.findall(text)
    masked += [0 for s in spelled if (bare := "".join(c for c in s.lower() if c.isalpha())) in INSULTS or lexicon.weight(bare)]
    you = [i for i, w in enumerate(words) if w in SECOND_PERSON]
    near, at = 0, 0
    for i in sorted({*known, *masked}):
        while at < len(you) and you[at] < i - NEAR:
            at += 1
        near += at < len(you) and you[at] <= i + NEAR
    letters = sum(map(str.isalpha, text)) or 1
    capitals = sum(map(str.isupper, text))
    signs = len(text) - sum(map(str.isalnum, text)) - sum(map(str.isspace, text))
    size = len(text) or 1
    return [float(x) for x in (
        len(given), len(given) / n, len(hits), len(hits) / n, sum(w for _, w in hits) / n, max((w for _, w in hits), default=0.0),
        len({words[i] for i in known}), len(masked), len(masked) / n, len(you) / n, near, near / n,
        capitals / letters, sum(1 for w in raw if len(w) > 2 and w.isupper()) / n, len(SIGNS.findall(text)) / n, signs / size,
        len(REPEATED.findall(text)) / n, mixed / n, inner / n, len(spelled) / n)]


def with_features(docs: DataFrame, lexicons: list[Lexicon], keep: list[str], text: str = "text", part: str | None = None) -> DataFrame:
    """``keep`` columns and ``features``, a vector; ``part`` says which of several lexicons a row takes. The text is a
    column, or a field of the first column of ``keep``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column(0)
            texts = (column.field(text) if pa.types.is_struct(column.type) else batch.column(text)).to_pylist()
            which = batch.column(part).to_pylist() if part else [0] * len(texts)
            rows = [features(t, lexicons[i]) for t, i in zip(texts, which)]
            kept = [batch.column(i) for i in range(len(keep))]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(rows, pa.list_(pa.float64()))], names=[*keep, "features"])

    rows = docs.select(*keep, *[text] * (text in docs.columns))
    out = rows.mapInArrow(run, T.StructType([*rows.schema.fields[:len(keep)], T.StructField("features", T.ArrayType(T.DoubleType()))]))
    return out.withColumn("features", array_to_vector("features"))


def fold(key: Column, parts: int, salt: str) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(parts)).cast("int")


def word_counts(rows: DataFrame) -> DataFrame:
    """(word, fold, bad, all): documents with each word or stem, and those of label 1; per fold also
    a row for the word ``""``, which is in every document."""
    digest = F.sha2(F.encode("text", "UTF-8"), 256)
    once = rows.select("text", "label", "fold", digest.alias("digest")).dropDuplicates(["digest", "label", "fold"])
    words = F.array_distinct(F.transform(F.split(F.lower("text"), r"\s+"), lambda w: F.regexp_replace(w, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", "")))

    def stems(n: int) -> Column:
        longer = F.filter("words", lambda w: F.length(w) > n)
        return F.transform(longer, lambda w: F.concat(F.left(w, F.lit(n)), F.lit("*")))

    items = F.array_union(F.array(F.lit("")), F.array_distinct(F.concat("words", *[stems(n) for n in STEMS])))
    listed = once.select("label", "fold", words.alias("words"))
    return listed.select("label", "fold", F.explode(items).alias("word")).groupBy("word", "fold").agg(
        F.sum("label").alias("bad"), F.count("*").alias("all"))


def learned_lexicon(counts: DataFrame, without: int | None = None, most: int = LEARNED_WORDS) -> Lexicon:
    """Words and stems that go with label 1 in all folds but one: log odds, for the ``most`` of the
    highest z. A word whose stem is in, with odds as high, is left out."""
    summed = counts.where(F.lit(without is None) | (F.col("fold") != F.lit(-1 if without is None else without))).groupBy("word").agg(
        F.sum("bad").alias("bad"), F.sum("all").alias("all"))
    totals = summed.where("word = ''").first()
    if totals is None:
        return Lexicon({})
    bad, good = F.col("bad") + 0.5, F.col("all") - F.col("bad") + 0.5
    odds = F.log(bad / (totals["bad"] + 1)) - F.log(good / (totals["all"] - totals["bad"] + 1))
    z = odds / F.sqrt(1 / bad + 1 / good)
    found = summed.where((F.col("bad") >= LEAST_DOCS) & (F.col("word") != "")).select("word", odds.alias("odds"), z.alias("z")).where(
        F.col("z") >= LEAST_Z).orderBy(F.desc("z"), "word").limit(most)
    odds_of = {r["word"]: r["odds"] for r in found.collect()}
    stem_odds = lambda w: max((odds_of.get(w.rstrip("*")[:n] + "*", 0.0) for n in STEMS if len(w.rstrip("*")) > n), default=0.0)
    return Lexicon({w: x for w, x in odds_of.items() if stem_odds(w) < x})


class Toxicity:
    """A fitted scorer."""

    def __init__(self, lexicon: Lexicon, trees, calibration):
        self.lexicon, self.trees, self.calibration = lexicon, trees, calibration

    def score(self, docs: DataFrame, keep: list[str], text: str = "text", into: str = "score") -> DataFrame:
        """``keep`` columns, whatever their names, and the score, 0 to 1. Equal calibrated scores keep the trees' order by
        a thousandth."""
        rest = [F.col(f"`{c}`") for c in keep]
        if self.trees is None:
            return docs.select(*rest, F.lit(0.0).alias(into))
        # the models add columns of fixed names; those of the rows travel in a struct
        narrow = docs.select(F.struct(*rest, *[F.col(f"`{text}`")] * (text not in keep)).alias("kept"))
        raw = self.trees.transform(with_features(narrow, [self.lexicon], ["kept"], text)).select(
            "kept", vector_to_array("probability")[1].alias("raw"))
        if self.calibration is None:
            return raw.select(*[F.col("kept")[c].alias(c) for c in keep], F.col("raw").alias(into))
        score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("calibrated") * 0.999 + F.col("raw") * 0.001))
        return self.calibration.transform(raw).select(*[F.col("kept")[c].alias(c) for c in keep], score.alias(into))


def sample_share(known: DataFrame, bound: int) -> Column:
    """The share of keys taken of each label: all of the rarer one up to half of ``bound``, and what is left for the other."""
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    rarer, other = sorted((0.0, 1.0), key=lambda x: sizes.get(x, 0))
    taken = min(sizes.get(rarer, 0), bound // 2)
    shares = {rarer: taken / max(1, sizes.get(rarer, 0)), other: (bound - taken) / max(1, sizes.get(other, 0))}
    return F.when(F.col("label") == 1.0, F.lit(float(shares[1.0]))).otherwise(F.lit(float(shares[0.0])))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, key: str = "doc_id", text: str = "text", label: str = "toxic",
        bound: int = TRAIN_ROWS) -> Toxicity:
    """Learn from labelled rows where ``learn``, a condition on the key, holds."""
    known = cut_lineage(labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & learn).groupBy(key).agg(
        F.max(F.col(label).cast("double")).alias("label")), "known")
    chosen = cut_lineage(known.where(F.xxhash64(F.col(key), F.lit("train")) / F.lit(2.0 ** 64) + 0.5 < sample_share(known, bound)).limit(2 * bound), "chosen")
    text = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(key, text.alias("text")).join(F.broadcast(chosen), key).groupBy(key, "label").agg(
        F.min_by("text", F.sha2(F.encode("text", "UTF-8"), 256)).alias("text"))
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64(F.col(key), F.lit("part")), key)) % 5
    rows = cut_lineage(rows.select("text", "label", fold(F.col(key), FOLDS, "fold").alias("fold"), place.alias("part")), "train")
    counts = cut_lineage(word_counts(rows), "words")
    lexicons = [learned_lexicon(counts, k) for k in range(FOLDS)]
    table = cut_lineage(with_features(rows, lexicons, ["label", "part", "fold"], part="fold").coalesce(8), "features")
    lexicon = learned_lexicon(counts)
    fitting, held = table.where(F.col("part") != HELD), table.where(F.col("part") == HELD)
    both = lambda part: {r["label"] for r in part.select("label").distinct().collect()} == {0.0, 1.0}
    if not both(fitting):
        return Toxicity(lexicon, None, None)
    trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, seed=11, minInstancesPerNode=5).fit(fitting)
    if not both(held):
        return Toxicity(lexicon, trees, None)
    raw = trees.transform(held).select("label", vector_to_array("probability")[1].alias("raw"))
    # equal scores are one row with a weight, so no task of the fit gets them all
    steps = raw.groupBy("raw").agg(F.avg("label").alias("label"), F.count("*").cast("double").alias("weight"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", weightCol="weight", predictionCol="calibrated").fit(steps)
    return Toxicity(lexicon, trees, calibration)


def held_out(key: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the key as text, modulo 3, is 1."""
    return F.crc32(F.encode(key.cast("string"), "UTF-8")) % 3 == 1
