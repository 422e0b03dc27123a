"""Toxicity by noisy-channel deobfuscation and a lexicon learned from labels.

Writers hide words by look-alike characters, by letters of other scripts, by
repeating letters and by spacing letters out.  Here a stretch that shows such signs becomes a lattice:
each character may stand for itself or, at a cost, for the letters it resembles;
a repetition may be one letter or two; a separator between single letters may
be nothing.  A Viterbi search under a character language model, counted over
the whole corpus, picks the likeliest reading.  Everything else has a lattice
of one path and is read as it stands.

The restored words and their beginnings are then looked up in a lexicon: for
each, the smoothed share of toxic texts among the labelled texts that have it.
A text scores as its most telling word does.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, text_chunks, written

#: Most labelled rows that the lexicon is fitted on.
SAMPLE = 20_000
#: A word or beginning needs so many toxic texts, and this smoothed share, to enter the lexicon.
LEAST_TOXIC, LEAST_SHARE, SMOOTHING = 4, 0.3, 4.0
#: Lengths of the beginnings that are looked up besides whole words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Log costs of the channel: a look-alike, one letter fewer in a repetition, a dropped separator.
LOOKALIKE, REPEAT, SPACED = -1.5, -0.5, -0.3
#: After so many places the readings so far are joined to strings, which take less memory than one node a place.
JOINED = 4096
#: Longer stretches are read anew each time they come, so that what is remembered stays small.
REMEMBERED = 128

#: Look-alike characters and the letters they stand for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
#: Letters of other scripts that look like Latin ones; they are read so only in words that have Latin letters.
HOMOGLYPHS = {
    "а": "a", "в": "b", "е": "e", "и": "u", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x",
}
#: Look-alikes that end or open words as marks too; the others hardly stand in a word for themselves.
MARKS = "!¡|+("
SEPARATORS = " .-_*~'/\\,"
PUNCTUATION = ".,;:!?\"'()[]{}<>|*#%&$@+-_=/\\~^`“”‘’«»…¡¿"

# classes of characters: 1-26 a-z (accents folded), 27 other letters, 28 look-alikes, 29 separators, 30 letters that look like Latin ones, 0 all else
_OTHER, _LOOK, _SEP, _TWIN = 27, 28, 29, 30


def _classes() -> np.ndarray:
    table = np.zeros(0x3000, np.uint8)
    for cp in range(len(table)):
        c = chr(cp)
        if c in HOMOGLYPHS:
            table[cp] = _TWIN
        elif c.isalpha():
            base = unicodedata.normalize("NFD", c.lower())[:1]
            table[cp] = ord(base) - 96 if "a" <= base <= "z" else _OTHER
        elif c in LOOKALIKES:
            table[cp] = _LOOK
        elif c in SEPARATORS:
            table[cp] = _SEP
    return table


_CLASSES = _classes()


def classed(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASSES[np.minimum(points, len(_CLASSES) - 1)]


def plain(text: str) -> str:
    """Lower case, with full-width, styled and joined forms of letters as plain ones."""
    return unicodedata.normalize("NFKC", text).lower()


def four_grams(classes: np.ndarray) -> np.ndarray:
    """Codes of the four-letter strings that end at each place; what is no letter is a boundary, 0."""
    c = np.where(classes <= _OTHER, classes, np.where(classes == _TWIN, _OTHER, 0)).astype(np.int32)
    c = c[np.r_[True, (c[1:] != 0) | (c[:-1] != 0)]]  # boundaries in a row are one
    padded = np.r_[np.zeros(3, np.int32), c]
    return (padded[:-3] << 15) | (padded[1:-2] << 10) | (padded[2:-1] << 5) | padded[3:]


def count_four_grams(texts: DataFrame) -> DataFrame:
    """(gram, n) over the column ``text`` of all rows."""

    def count(batches):
        total = np.zeros(1 << 20, np.int64)
        for _, chunk in text_chunks(batches, "text"):
            total += np.bincount(four_grams(classed(plain("\n".join(chunk)))), minlength=1 << 20)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(total[there])], names=["gram", "n"])

    return texts.mapInArrow(count, "gram int, n long").groupBy("gram").agg(F.sum("n").alias("n"))


class LanguageModel:
    """Interpolated model of a character given the three before it, from four-gram counts."""

    def __init__(self, counts: np.ndarray):
        four = counts.reshape(32, 32, 32, 32).astype(np.float64)
        total = np.full((1, 1, 1, 32), 1 / 28)
        for axes, weight in (((0, 1, 2), 50.0), ((0, 1), 20.0), ((0,), 10.0), ((), 5.0)):
            part = four.sum(axis=axes, keepdims=True) if axes else four
            total = (part + weight * total) / (part.sum(axis=3, keepdims=True) + weight)
        self.log = np.log(np.maximum(total, 1e-12)).astype(np.float32).reshape(-1, 32)


def suspicious(classes: np.ndarray) -> list[tuple[int, int]]:
    """Stretches [start, end) whose lattice has more than one path."""
    n = len(classes)
    if n < 2:
        return []
    twin = classes == _TWIN
    letter = (classes >= 1) & (classes <= _OTHER) | twin
    look, sep = classes == _LOOK, classes == _SEP
    solid = letter | look
    padded = np.r_[False, solid, False]
    starts, ends = np.flatnonzero(solid & ~padded[:-2]), np.flatnonzero(solid & ~padded[2:]) + 1

    def has(what: np.ndarray) -> np.ndarray:
        places = np.flatnonzero(what)
        return np.searchsorted(places, ends) > np.searchsorted(places, starts)

    # a letter and a look-alike, wherever they stand, or a letter three times in a row
    same = letter[2:] & (classes[2:] == classes[1:-1]) & (classes[2:] == classes[:-2]) & (classes[2:] < _OTHER)
    held = (has(letter) & has(look)) | (has((classes >= 1) & (classes < _OTHER)) & has(twin)) | has(same)
    spans = set(zip(starts[held].tolist(), ends[held].tolist(), strict=True))
    # two or more single letters or look-alikes, one letter at least, with separators between each two
    at = np.flatnonzero(~sep | ~np.r_[False, sep[:-1]])  # the first separator of each run stands for all
    alone, gap, real = solid[at], sep[at], letter[at]
    beside = np.r_[False, alone, False]
    single = alone & ~beside[:-2] & ~beside[2:]
    step = single[:-2] & gap[1:-1] & single[2:]
    end = -1
    for i in np.flatnonzero(step).tolist():
        if i < end:
            continue
        j = i
        while j + 2 < len(at) and step[j]:
            j += 2
        end = j + 1
        if real[i:end].any():
            spans.add((int(at[i]), int(at[j]) + 1))
    return sorted(spans)


def spelled(node: tuple) -> str:
    """The text of a chain of (chain before, text)."""
    out = []
    while node:
        node, text = node
        out.append(text)
    return "".join(reversed(out))


def arcs_at(span: str, i: int, end: int, kind: int, spaced: bool, all_read: bool = False) -> list[tuple[tuple[int, ...], str, float, int]]:
    """(letters as classes, text, log cost, place after) for one place of the lattice; ``end`` is where its run of one character ends."""
    c, run = span[i], end - i
    if 1 <= kind <= _OTHER:
        here = [((kind,), c, 0.0, i + 1)]
        if run >= 3:
            here.append(((kind,), c, REPEAT * (run - 1), end))
            here.append(((kind, kind), c + c, REPEAT * (run - 2), end))
    elif kind == _TWIN:
        here = [] if all_read else [((_OTHER,), c, 0.0, i + 1)]
        here.append(((ord(HOMOGLYPHS[c]) - 96,), HOMOGLYPHS[c], LOOKALIKE, i + 1))
    elif kind == _LOOK:
        here = [] if all_read and c not in MARKS else [((0,), c, 0.0, i + 1)]
        for letter in LOOKALIKES[c]:
            here.append(((ord(letter) - 96,), letter, LOOKALIKE, i + 1))
            if run >= 3:
                here.append(((ord(letter) - 96,), letter, LOOKALIKE + REPEAT * (run - 1), end))
    elif spaced:  # a separator that stays parts words
        here = [((0,), " ", 0.0, i + 1), ((), "", SPACED, i + 1)]
    else:
        here = [((0,), c, 0.0, i + 1)]
    return here


def restore(span: str, model: LanguageModel, all_read: bool = False) -> str:
    """The likeliest reading of a suspicious stretch, in time and memory linear in its length.

    With ``all_read`` only the readings count that take every look-alike but :data:`MARKS` for a letter.
    """
    classes = classed(span).tolist()
    if _SEP in classes:  # one separator says what several say
        span = "".join(c for c, k, before in zip(span, classes, [0, *classes], strict=False) if k != _SEP or before != _SEP)
        classes = classed(span).tolist()
    spaced = len(span) > 2 and all(c == _SEP for c in classes[1::2])
    run_ends = list(range(1, len(span) + 1))
    for i in range(len(span) - 2, -1, -1):
        if span[i] == span[i + 1]:
            run_ends[i] = run_ends[i + 1]
    # for each place still ahead: the state (last three classes) to its score, the reading's end and what was joined before
    ahead: dict[int, dict[int, tuple[float, tuple, tuple]]] = {0: {0: (0.0, (), ())}}
    log = model.log
    for i in range(len(span)):
        states = ahead.pop(i)
        if i and i % JOINED == 0:
            states = {s: (score, (), (joined, spelled(node))) for s, (score, node, joined) in states.items()}
        here = arcs_at(span, i, run_ends[i], classes[i], spaced, all_read)
        for state, (score, node, joined) in states.items():
            for letters, add, cost, after in here:
                s, value = state, score + cost
                for k in letters:
                    if k or s & 31:  # boundaries in a row are one, as they were counted
                        value += float(log[s, k])
                        s = ((s << 5) | k) & 0x7FFF
                then = ahead.setdefault(after, {})
                if (old := then.get(s)) is None or value > old[0]:
                    then[s] = (value, (node, add), joined)
    ends = ((value + (float(log[s, 0]) if s & 31 else 0.0), spelled(joined) + spelled(node)) for s, (value, node, joined) in ahead[len(span)].items())
    return max(ends)[1]


def readings(span: str, model: LanguageModel) -> list[str]:
    """The likeliest reading, and the likeliest one that leaves no look-alike, where they differ from the stretch.

    Both are looked up, since a word that ends where a common one does ("hat3")
    is likelier as it stands; what the lexicon doesn't hold tells nothing.
    """
    found = {restore(span, model)}
    if any(c in HOMOGLYPHS or (c in LOOKALIKES and c not in MARKS) for c in span):
        found.add(restore(span, model, all_read=True))
    return sorted(found - {span})


class Restorer:
    """Words of texts after restoration; stretches once read are remembered."""

    def __init__(self, model: LanguageModel, most: int = 200_000):
        self.model, self.known, self.most = model, {}, most

    def words(self, texts: list[str]) -> list[set[str]]:
        lowered = [plain(x) for x in texts]
        joined = "\n".join(lowered)
        starts = np.cumsum([0] + [len(x) + 1 for x in lowered])
        added: dict[int, list[str]] = {}
        spans = suspicious(classed(joined))
        if len(self.known) > self.most:
            self.known = {}
        owners = np.searchsorted(starts, [a for a, _ in spans], side="right") - 1
        for (a, b), owner in zip(spans, owners.tolist(), strict=True):
            span = joined[a:b]
            if (read := self.known.get(span)) is None:
                read = readings(span, self.model)
                if len(span) <= REMEMBERED:
                    self.known[span] = read
            if read:
                added.setdefault(owner, []).extend(read)
        out = []
        for i, x in enumerate(lowered):
            words = set(x.split())
            for read in added.get(i, ()):
                words.update(read.split())
            out.append({w.strip(PUNCTUATION) for w in words})
        return out


def beginnings(words: set[str]) -> set[str]:
    """The beginnings of the longer words."""
    out: set[str] = set()
    for n in BEGINNINGS:
        out.update({w[:n] for w in words if len(w) > n})
    return out


def sketch_of(text: str) -> int:
    """The least hash of three words in a row: nearly equal texts mostly share it, others hardly ever."""
    words = text.lower().split()
    if len(words) < 3:
        return xxhash.xxh3_64_intdigest(" ".join(words))
    return min(map(xxhash.xxh3_64_intdigest, map(" ".join, zip(words, words[1:], words[2:], strict=False))))


def shares(rows: DataFrame, base: float) -> dict[str, float]:
    """Smoothed share of toxic texts for each telling feature, from (toxic, features)."""
    share = (F.col("toxic") + SMOOTHING * base) / (F.col("n") + SMOOTHING)
    found = (
        rows.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum("toxic").cast("double").alias("toxic"), F.count(F.lit(1)).alias("n"))
        .filter((F.col("toxic") >= LEAST_TOXIC) & (share >= LEAST_SHARE) & (F.col("feature") != ""))
        .select("feature", share.alias("share"))
        .collect()  # bounded by the sample's bound
    )
    return {r["feature"]: float(r["share"]) for r in found}


def learn(sample: DataFrame, model) -> tuple[dict[str, float], dict[str, float], float]:
    """Telling words, telling beginnings and the share of toxic rows, from (text, toxic).

    Texts with one sketch and label count as one, so that copies of a toxic
    text don't make all its words telling.  Beginnings are counted over the
    words that don't tell by themselves: they stand for families of words.
    """

    def restored(batches):
        restorer = Restorer(model.value)
        for batch, texts in text_chunks(batches, "text"):
            words = restorer.words(texts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([sketch_of(t) >> 1 for t in texts], pa.int64()),
                    batch.column(batch.schema.get_field_index("toxic")),
                    pa.array([sorted(w) for w in words], pa.list_(pa.string())),
                ],
                names=["sketch", "toxic", "features"],
            )

    rows = sample.select("text", "toxic").mapInArrow(restored, "sketch long, toxic int, features array<string>")
    rows = written(rows.dropDuplicates(["sketch", "toxic"]), "toxicity-sample")
    base = float(rows.agg(F.avg(F.col("toxic").cast("double"))).first()[0] or 0.0)
    whole = shares(rows, base)

    def begun(batches):
        for batch in batches:
            sets = [sorted(beginnings(set(w) - whole.keys())) for w in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.string()))], names=["toxic", "features"])

    families = shares(rows.select("toxic", "features").mapInArrow(begun, "toxic int, features array<string>"), base)
    return whole, families, base


def score(
    docs: DataFrame,
    labels: DataFrame,
    held_out=lambda doc_id: F.lit(False),
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = 0.7,
) -> DataFrame:
    """For each row: doc_id, held_out, score, predicted and the word that told most.

    ``held_out`` maps the id column to a condition; rows for which it holds are
    never learned from.  Null and empty texts have no words and score below any
    word of the lexicon.  Equal texts score alike.  Without labels of both
    kinds every score is the least.  Several labels of one id count as toxic if
    any is.  An empty table gives an empty result; texts are read whole.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    counts = np.zeros(1 << 20, np.int64)
    grams = count_four_grams(rows.select("text")).toArrow()  # at most 2**20 rows
    counts[np.asarray(grams["gram"])] = np.asarray(grams["n"])
    model = spark.sparkContext.broadcast(LanguageModel(counts))
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    chosen = known.filter(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    sample = rows.join(F.broadcast(chosen), "doc_id").filter("text is not null")
    lexicon = spark.sparkContext.broadcast(learn(sample, model))

    def run(batches):
        whole, families, base = lexicon.value
        restorer = Restorer(model.value)
        none = min(0.02, base)
        for batch, texts in text_chunks(batches, "text"):
            scores, told = [], []
            for words in restorer.words(texts):
                known = words & whole.keys()
                begun = beginnings(words - known) & families.keys()
                best = max([*((whole[w], w) for w in known), *((families[w], w) for w in begun)], default=(none, None))
                scores.append(best[0])
                told.append(best[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array(told, pa.string())], names=["doc_id", "score", "telling"]
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, score double, telling string").select(
        "doc_id",
        F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "telling",
    )
