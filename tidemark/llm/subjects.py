"""Subject areas of posts, from labelling functions whose accuracies are learned.

Every sentence of a post's own text gets the votes of five labelling functions:

- ``seed``: words of a short hand-made lexicon;
- ``lexicon``: words and pairs of words learned from labelled posts;
- ``address``: a web address in the author's own text speaks for advertising, which has no subject;
- ``section``: what most other sentences of the thread are about;
- ``source``: what most sentences of the board are about.

A latent-class model over all sentences of the corpus learns how often each function votes and how
often it is right, and gives the posterior of a sentence's subject. A post has the subjects that, by the
posteriors of its sentences, at least a third of them have with a probability of a half or more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.posts import _WORD, features, has_address, sentences, words_of
from tidemark.operators.skew import lookup
from tidemark.session import cut, spread

NONE = "none"

# A few words of each subject in English, German and Spanish.
SEEDS = {
    "science": "telescope enzyme galaxy hypothesis genome photon isotope microscope teleskop galaxie hypothese erbgut isotop telescopio hipótesis isótopo",
    "law": "plaintiff statute custody barrister attorney lawsuit arbitration kläger urteil testament berufung amtsgericht demanda sentencia testigo juzgado herencia",
    "sport": "goalkeeper referee striker midfielder coach sprint relegated torwart schiedsrichter elfmeter halbfinale hürdenlauf portero árbitro penalti semifinal banquillo",
    "software": "compiler rebase kernel mutex regex segfaults debugger datenbank speicherleck quellcode bibliothek compilador biblioteca código puntero depurado",
    "medicine": "migraine dosage surgeon vaccine prescription insulin thyroid schilddrüse hausarzt blutdruck migräne impfung vacuna fiebre enfermera antibiótico",
    "finance": "mortgage deductible dividend overdraft pension portfolio rücklage steuerklasse indexfonds bausparvertrag dividende hipoteca inflación dividendo ahorro",
    "cooking": "yeast marinade braise custard dumpling flour butter hefe knödel vanillesoße brühe levadura caldo adobo natillas lentejas",
    "travel": "hostel itinerary luggage visa layover ferry guesthouse altstadt anschlussflug bordkarte nachtzug fähre frontera albergue equipaje transbordador",
    "music": "amplifier violin chord guitar cello choir syncopated schlagzeug klavierauszug geige akkord batería acorde violín partitura",
    "gardening": "compost mulch seedling greenhouse pruning lawn slug gewächshaus rasen setzling blattläuse invernadero riego esqueje pulgón",
}


@dataclass(frozen=True)
class Options:
    """Parameters of the fit and of the decision."""

    most_labelled: int = 20_000  #: labelled posts the lexicon is learned from, by a hash of their ids
    most_labelled_bytes: int = 32 * 1024 * 1024  #: bytes of text they may have together
    rounds: int = 4
    purity: float = 0.5  #: share of a term's weighted occurrences that one class must have
    least_count: int = 3
    share: float = 1 / 3  #: of a post's sentences that make a subject


#: Tokens whose words are remembered in a task.
MOST_TOKENS = 500_000
_BREAK, _UNKNOWN, _SEVERAL = -2, -1, -10


class _Tokens(dict):
    """Numbers of tokens: of the only word in it, _UNKNOWN, or _SEVERAL - i for entry i of ``several``."""

    def __init__(self, numbers: dict[str, int]):
        super().__init__(numbers)
        self.numbers, self.several = numbers, []

    def __reduce__(self):
        return _Tokens, (self.numbers,)

    def __missing__(self, token: str) -> int:
        own = [self.numbers.get(w, _UNKNOWN) for w in words_of(token)]
        if len(own) == 1:
            number = own[0]
        else:
            self.several.append(own)
            number = _SEVERAL - (len(self.several) - 1)
        if len(self) < MOST_TOKENS:
            self[token] = number
        return number


class Lexicon:
    """Seeds and learned weights of terms for each class; the last class is ``none``."""

    def __init__(self, classes: list[str]):
        self.classes = classes
        self.seeds = {word: classes.index(s) for s, words in SEEDS.items() if s in classes for word in words.split()}
        self.fill({})

    def fill(self, weights: dict[str, np.ndarray]) -> None:
        k = len(self.classes)
        terms = [*self.seeds, *(t for t in weights if t not in self.seeds)]
        self.rows = {term: i for i, term in enumerate(terms)}
        # per term its class as a seed, its learned weights, and whether it has any; the last row is for no term
        self.table = np.zeros((len(terms) + 1, 2 * k + 1), np.float32)
        for term, c in self.seeds.items():
            self.table[self.rows[term], c] = 1
        for term, values in weights.items():
            self.table[self.rows[term], k : 2 * k] = values
            self.table[self.rows[term], 2 * k] = 1
        # words by number, and the rows of single words and of pairs by their words' numbers
        known = {w: i for i, w in enumerate(dict.fromkeys(w for t in terms for w in t.split(" ")))}
        self.tokens = _Tokens(known)
        self.single = np.full(len(known) + 1, len(terms))
        pairs = {}
        for term, row in self.rows.items():
            own = [known[w] for w in term.split(" ")]
            if len(own) == 1:
                self.single[own[0]] = row
            else:
                pairs[own[0] * len(known) + own[1]] = row
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rows = np.array([pairs[key] for key in self.pair_keys.tolist()], np.int64)

    def _terms(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Sentence and row of every distinct term of every sentence, in order; each sentence has the row for none as well."""
        known, n, nothing = len(self.tokens.numbers), len(texts), len(self.rows)
        self.tokens[chr(10)] = _BREAK
        numbers = list(map(self.tokens.__getitem__, _LINES.findall(chr(10).join(texts).lower())))
        ids = np.array(numbers, np.int64)
        if len(ids) and ids.min() <= _SEVERAL:
            ids = np.array([j for i in numbers for j in (self.tokens.several[_SEVERAL - i] if i <= _SEVERAL else (i,))], np.int64)
        at = np.cumsum(ids == _BREAK)
        ids, at = ids[ids != _BREAK], at[ids != _BREAK]
        rows, places = [np.full(n, nothing), self.single[ids]], [np.arange(n), at]
        if len(self.pair_keys):
            first, second = ids[:-1], ids[1:]
            key = np.where((at[1:] == at[:-1]) & (first >= 0) & (second >= 0), first * known + second, -1)
            place = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            hit = self.pair_keys[place] == key
            rows.append(self.pair_rows[place[hit]])
            places.append(at[1:][hit])
        both = np.unique(np.concatenate(places) * (nothing + 1) + np.concatenate(rows))
        return both // (nothing + 1), both % (nothing + 1)

    def votes(self, texts: list[str]) -> np.ndarray:
        """Per sentence the votes of the seed and the learned lexicon, 0 for none given, else the class's number from 1; 1 if the latter is sure.

        Sentences are given without line breaks; all are looked up at once.
        """
        if not texts:
            return np.zeros((0, 3), np.int64)
        k = len(self.classes)
        at, rows = self._terms(texts)
        sums = np.add.reduceat(self.table[rows], np.searchsorted(at, np.arange(len(texts))), axis=0)
        every = np.arange(len(texts))
        seen = sums[:, :k]
        order = np.sort(seen, axis=1)
        seed = np.where((order[:, -1] > order[:, -2]) if k > 1 else order[:, -1] > 0, seen.argmax(axis=1) + 1, 0)
        score = sums[:, k : 2 * k]
        score[:, -1] += 0.7
        best = score.argmax(axis=1)
        top = score[every, best].copy()
        score[every, best] = -np.inf
        found = sums[:, 2 * k] > 0
        return np.stack([seed, np.where(found, best + 1, 0), found & (top - score.max(axis=1) > 2.0)], axis=1).astype(np.int64)


_LINES = re.compile(chr(10) + "|" + _WORD.pattern)


def labelled_sample(documents: DataFrame, labels: DataFrame, options: Options) -> list:
    """Labelled posts with the set of their labels, brought to the driver: a sample bounded in rows and in bytes.

    The first ``most_labelled`` labelled ids by their hash, of which as many are taken, in that order, as have no more
    than ``most_labelled_bytes`` of text together.
    """
    known = labels.where("doc_id IS NOT NULL AND subject IS NOT NULL").groupBy("doc_id").agg(F.collect_set("subject").alias("subjects"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(options.most_labelled)
    # broadcast: a row of an id and at most as many subjects as there are, most_labelled times
    found = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    # of a repeated id one text, so that there are no more rows than ids
    once = cut(found.groupBy("doc_id").agg(F.max("text").alias("text"), F.first("subjects").alias("subjects")))
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    in_order = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over no more than most_labelled numbers
    taken = once.select("doc_id", size.alias("size")).withColumn("total", F.sum("size").over(in_order)).where(F.col("total") <= options.most_labelled_bytes)
    return once.join(F.broadcast(taken.select("doc_id")), "doc_id", "left_semi").select("text", "subjects").collect()


def learn(sample: list, subjects: list[str], options: Options = Options()) -> Lexicon:
    """The lexicon from labelled posts.

    A post's label says which subjects its sentences may have, not which sentence has which; so the sentences'
    classes are latent and estimated in turn with the terms' weights. Seeds start it, wrong labels are
    outvoted since every label leaves a chance for any class. Only terms that lean to one class count.
    """
    classes = [*subjects, NONE]
    lexicon = Lexicon(classes)
    number, k = {c: i for i, c in enumerate(classes)}, len(classes)
    vocabulary: dict[str, int] = {}
    posts_with: dict[int, set[int]] = {}
    rows, columns, priors = [], [], []
    for post, (text, labels) in enumerate(sample):
        given = [number[s] for s in labels if s in number and s != NONE]
        prior = np.full(k, 0.01)
        prior[given] += 0.85 / max(1, len(given))
        prior[-1] += 0.12 if given else 1.0
        for sentence in sentences(text):
            for term in set(features(sentence)):
                rows.append(len(priors))
                columns.append(vocabulary.setdefault(term, len(vocabulary)))
                held = posts_with.setdefault(columns[-1], set())
                if len(held) < 2:
                    held.add(post)
            priors.append(prior / prior.sum())
    if not priors:
        return lexicon
    rows_, columns_, prior = np.array(rows), np.array(columns), np.array(priors)
    n, v = len(prior), len(vocabulary)
    unlabelled = prior[:, -1] > 0.5
    # one post, and so one wrong label, is not enough to teach a term
    shared = np.array([len(posts_with[i]) > 1 for i in range(v)])

    def scores(weights: np.ndarray) -> np.ndarray:
        return np.stack([np.bincount(rows_, weights[columns_, c], n) for c in range(k)], axis=1)

    seeds = np.zeros((v, k))
    for word, c in lexicon.seeds.items():
        if word in vocabulary:
            seeds[vocabulary[word], c] = 3.0
    score = scores(seeds)
    score[:, -1] += 0.3
    weights = seeds
    for step in range(options.rounds + 1):
        logits = score + np.log(prior)
        logits -= logits.max(axis=1, keepdims=True)
        posterior = np.exp(logits)
        posterior /= posterior.sum(axis=1, keepdims=True)
        if step == options.rounds:
            break
        evidence = posterior.copy()
        evidence[:, -1] = np.where(unlabelled, 1.0, 0.5 * posterior[:, -1])
        counts = np.stack([np.bincount(columns_, evidence[rows_, c], v) for c in range(k)], axis=1)
        total = evidence.sum(axis=0)
        rate = (counts + total / total.sum()) / (total + 1e-9)
        share = rate / rate.sum(axis=1, keepdims=True)
        kept = (counts.sum(axis=1) >= (2 if step == 0 else options.least_count)) & (share.max(axis=1) >= options.purity) & shared
        weights = np.where(kept[:, None], np.log(np.maximum(share, 1e-3) * k), seeds)
        score = scores(weights)
        score[:, -1] += 0.7
    terms = list(vocabulary)
    used = np.flatnonzero(np.abs(weights).max(axis=1) > 0)
    lexicon.fill({terms[i]: weights[i] for i in used.tolist()})
    return lexicon


#: The labelling functions in the order of a pattern; ``lexicon`` votes as two functions, sure and unsure.
FUNCTIONS = ("seed", "unsure", "sure", "address", "section", "source")
_STARTS = np.array([0.85, 0.7, 0.95, 0.95, 0.5, 0.3])


def fit_latent(patterns: np.ndarray, counts: np.ndarray, k: int, rounds: int = 60) -> np.ndarray:
    """Posterior class of each pattern of votes, (patterns, k), by expectation maximisation.

    patterns: one row per pattern, one column per function, 0 for no vote, else the class from 1; the last
    class is ``none``. A function abstains with one probability for sentences with a subject and another
    for those without; when it votes it is right with a probability of its own for each of the two, and
    else wrong evenly. Each probability is kept off 0 and 1.
    """
    n, m = patterns.shape
    kind = np.array([0] * (k - 1) + [1])  # subject, or none
    accuracy = np.repeat(_STARTS[:m, None], 2, axis=1)
    silence = np.tile(np.array([[0.4, 0.8]]), (m, 1))
    # an address and a sure vote say something about sentences without a subject as well
    prior = np.full(k, 1 / k)
    posterior = np.full((n, k), 1 / k)
    votes = patterns > 0
    right = patterns[:, :, None] == np.arange(1, k + 1)[None, None, :]
    for _ in range(rounds):
        a, s = accuracy[:, kind], silence[:, kind]
        spoken = np.log(1 - s) + np.where(right, np.log(a), np.log((1 - a) / (k - 1)))
        logits = np.where(votes[:, :, None], spoken, np.log(s)[None, :, :]).sum(axis=1) + np.log(prior)
        logits -= logits.max(axis=1, keepdims=True)
        posterior = np.exp(logits)
        posterior /= posterior.sum(axis=1, keepdims=True)
        weight = posterior * counts[:, None]
        total = weight.sum(axis=0)
        prior = (total + 1) / (total.sum() + k)
        for j in range(m):
            for group in (0, 1):
                w = weight[:, kind == group]
                voted = w[votes[:, j]].sum()
                correct = (w * right[:, j][:, kind == group])[votes[:, j]].sum()
                # pseudo-counts hold a function with little evidence where it started
                accuracy[j, group] = np.clip((correct + 20 * _STARTS[j]) / (voted + 20), 0.05, 0.995)
                silence[j, group] = np.clip((w.sum() - voted + 1) / (w.sum() + 2), 0.001, 0.999)
    return posterior


def _vote_posts(lexicon, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = lexicon.value
        for batch in batches:
            texts, parts = batch.column("text"), []
            for start in range(0, len(texts), 128):
                own = [sentences(text) for text in texts[start : start + 128].to_pylist()]
                cast = words.votes([s for post in own for s in post])
                lengths = np.array([len(post) for post in own], np.int64)
                post = np.repeat(np.arange(len(own)), lengths)
                tallies = np.bincount(post * (k + 1) + cast[:, 1], minlength=len(own) * (k + 1)).reshape(len(own), k + 1)[:, 1:k].astype(np.int32)
                codes = ((cast[:, 0] * (k + 1) + cast[:, 1]) * 2 + cast[:, 2]).astype(np.int32)
                parts.append(
                    pa.RecordBatch.from_arrays(
                        [
                            *(batch.column(c).slice(start, len(own)) for c in ("doc_id", "thread", "board")),
                            pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)), pa.array(codes)),
                            pa.ListArray.from_arrays(pa.array(np.arange(len(own) + 1, dtype=np.int32) * (k - 1)), pa.array(tallies.ravel())),
                            pa.array([any(has_address(s) for s in post) for post in own], pa.bool_()),
                        ],
                        names=["doc_id", "thread", "board", "codes", "tally", "address"],
                    )
                )
            if parts:
                yield from pa.Table.from_batches(parts).combine_chunks().to_batches()

    return run


#: A posterior this near to 0 or 1 counts as certain.
CERTAIN = 0.01
#: From this many uncertain sentences on, the probability is judged by their expected number.
MANY = 2_000


def likely_at_least(chances: np.ndarray, least: int) -> bool:
    """Whether at least ``least`` of independent events with these chances happen with a probability of a half or more."""
    if least <= 0:
        return True
    if len(chances) < least:
        return False
    if len(chances) > MANY:  # the median lies within one of the mean
        return bool(chances.sum() >= least - 0.5)
    fewer = np.zeros(least)  # probability of each number below ``least``
    fewer[0] = 1.0
    for p in chances.tolist():
        fewer[1:] = fewer[1:] * (1 - p) + fewer[:-1] * p
        fewer[0] *= 1 - p
    return bool(1 - fewer.sum() >= 0.5)


def decide(lengths: np.ndarray, posteriors: np.ndarray, share: float) -> list[tuple[int, int]]:
    """Posts and their subjects: (post, class) where at least a ``share`` of its sentences have it, more likely than not.

    lengths: sentences of each post. posteriors: one row per sentence, a column per class, the last one for no subject.
    """
    have = np.flatnonzero(lengths > 0)
    if not len(have):
        return []
    starts = (np.cumsum(lengths) - lengths)[have]
    least = np.ceil(share * lengths[have] - 1e-9).astype(np.int64)
    surely = np.add.reduceat((posteriors >= 1 - CERTAIN).astype(np.int64), starts, axis=0)
    perhaps = np.add.reduceat((posteriors > CERTAIN).astype(np.int64), starts, axis=0)
    out = []
    for i, c in zip(*np.nonzero(perhaps[:, :-1] >= np.maximum(least, 1)[:, None]), strict=True):
        if surely[i, c] < least[i]:
            p = posteriors[starts[i] : starts[i] + lengths[have[i]], c]
            if not likely_at_least(p[(p > CERTAIN) & (p < 1 - CERTAIN)], int(least[i] - surely[i, c])):
                continue
        out.append((int(have[i]), int(c)))
    return out


def _majority(posts: DataFrame, key: str, name: str, k: int) -> DataFrame:
    """Per group of posts the subject that most sentences with one have, from 1; no row without a majority of half."""
    sums = posts.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.sum(F.col("tally")[c]).alias(f"c{c}") for c in range(k - 1)])
    each = [F.struct(F.col(f"c{c}").alias("n"), F.lit(c + 1).alias("class")) for c in range(k - 1)]
    best = F.array_max(F.array(*each))
    total = sum((F.col(f"c{c}") for c in range(k - 1)), F.lit(0))
    return sums.select(key, best.alias("best"), total.alias("total")).where("best.n > 0 AND best.n * 2 >= total").select(key, F.col("best.class").alias(name))


def assign_subjects(documents: DataFrame, labels: DataFrame, subjects: DataFrame, options: Options = Options()) -> DataFrame:
    """``doc_id`` and ``subject``: every subject that at least a third of a post's own sentences are about.

    documents: doc_id, text, thread_id, source. labels: doc_id, subject (``none`` for no subject), possibly
    wrong, missing or repeated. subjects: the names, in ``subject``; the list is short and fixed. A post
    without own sentences (null, empty, blank, withdrawn, all quotes) has no subject. Without labels only the seeds vote. A repeated row is judged like any other.

    The lexicon is learned from a sample bounded in rows and bytes (``Options``), and can't have more terms than that
    holds, so it may be broadcast. Everything else covers all posts: votes, the counts of vote patterns that
    the latent model is fitted to, and threads and boards. Patterns are at most a product of the numbers
    of classes, whatever the corpus. Hot threads and boards are added up before the shuffle, and
    their posts get the result without being shuffled (``skew.lookup``). A sentence's posterior goes into its post's
    decision as it is (``decide``).
    """
    spark = documents.sparkSession
    names = sorted(r[0] for r in subjects.where(F.col("subject").isNotNull() & (F.col("subject") != NONE)).select("subject").distinct().collect())
    kind = dict(documents.dtypes)["doc_id"]
    if not names:
        return spark.createDataFrame([], f"doc_id {kind}, subject string")
    classes = [*names, NONE]
    k = len(classes)
    lexicon = spark.sparkContext.broadcast(learn(labelled_sample(documents, labels, options), names, options))

    read = spread(documents.select("doc_id", "text", F.col("thread_id").cast("long").alias("thread"), F.lower(F.trim("source")).alias("board")))
    voted = read.mapInArrow(_vote_posts(lexicon, k), f"doc_id {kind}, thread long, board string, codes array<int>, tally array<int>, address boolean")
    posts = cut(voted.where("size(codes) > 0"))
    placed = lookup(posts, cut(_majority(posts, "thread", "section", k)), "thread", ["section"])
    placed = lookup(placed, cut(_majority(posts, "board", "source", k)), "board", ["source"])
    around = F.col("address").cast("int") * k * k + F.coalesce("section", F.lit(0)) * k + F.coalesce("source", F.lit(0))
    placed = placed.select("doc_id", "codes", around.cast("long").alias("around"))
    # one number for a pattern; at most as many as there are patterns of votes
    width = 2 * (k + 1) * (k + 1)
    pattern = F.col("around") * width + F.col("code")
    counted = placed.select(F.explode("codes").alias("code"), "around").groupBy(pattern.alias("pattern")).agg(F.count(F.lit(1)).alias("n")).collect()
    keys = np.array(sorted((r["pattern"], r["n"]) for r in counted), np.int64).reshape(-1, 2)
    code, places = keys[:, 0] % width, keys[:, 0] // width
    learned = code // 2 % (k + 1)
    patterns = np.stack(
        [
            code // 2 // (k + 1),
            np.where(code % 2 == 0, learned, 0),
            np.where(code % 2 == 1, learned, 0),
            np.where(places // (k * k) > 0, k, 0),
            places // k % k,
            places % k,
        ],
        axis=1,
    )
    posterior = fit_latent(patterns, keys[:, 1].astype(float), k) if len(keys) else np.zeros((0, k))
    table = spark.sparkContext.broadcast((keys[:, 0], posterior))
    share = options.share

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, chances = table.value
        for batch in batches:
            codes = batch.column("codes")
            lengths = codes.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            own = codes.flatten().to_numpy().astype(np.int64) + np.repeat(batch.column("around").to_numpy(), lengths) * width
            found = decide(lengths, chances[np.searchsorted(known, own)], share)
            at, names_ = [i for i, _ in found], [classes[c] for _, c in found]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(names_, pa.string())], names=["doc_id", "subject"])

    return placed.mapInArrow(judge, f"doc_id {kind}, subject string")
