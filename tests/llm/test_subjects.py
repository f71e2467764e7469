import itertools
import pickle

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.operators import skew

pytest.importorskip("tidemark.llm")
from tidemark.llm import posts, subjects  # noqa: E402


@pytest.mark.parametrize(
    ("text", "own"),
    [
        (None, []), ("", []), ("  \n ", []), ("[deleted]", []), ("[removed by moderator]", []), ("[gelöscht]", []),
        ("Hi all,\nOne thing. Two\nthings!\n\n-- \nsome_name, amateur baker and proud of it", ["One thing.", "Two things!"]),
        ("> quoted. more\n> > deeper\nMine.", ["Mine."]),
        ("On 2024-01-02, some_name wrote:\n> quoted\nMine.", ["Mine."]),
        ("Am 16.09.2024 schrieb some_name:\n> Zitat\nMeins.", ["Meins."]),
        ("[quote=a]one [quote=b]two[/quote] three[/quote]Mine.", ["Mine."]),
        ("<blockquote>a<br>b</blockquote>\nMine &amp;amp; yours.", ["Mine & yours."]),
        ("<p>Mine.</p><p>| barred</p>", ["Mine."]),
        ("Is it\nOn 2024-01-02, x wrote:\n> q\ntrue? Yes.", ["Is it true?", "Yes."]),
        ("PaguÃ© 3 euros.", ["Pagué 3 euros."]),
        ("Mine.\ncheers,\nsome_name", ["Mine."]), ("Mine.\nSent from my toaster", ["Mine."]), ("Mine.\n___________\nname\nmotto", ["Mine."]),
        ("Mine. <a title='" + "x" * 500 + "'>yours</a> [url=" + "y" * 500 + "]here", ["Mine.", "yours   here"]),
        ("On 2024-01-02, " + "name " * 60 + "wrote, as so often before and in so many words that nobody counts them any more:\n> q\nMine.", ["Mine."]),
        ("My uncle wrote a book. It says:\nall is well.", ["My uncle wrote a book.", "It says: all is well."]),
        ("[removed by " + "a moderator and " * 20 + "somebody]", []),
        ("Good evening to all of you who are still awake at this hour,\nMine.", ["Mine."]),
        ("Hello I have a question about the garden\nand the house.", ["Hello I have a question about the garden and the house."]),
        ("«Said so.» Mine! 'Yours?' Ours.", ["«Said so.", "Mine!", "'Yours?", "Ours."]),
        ("> <p>quoted</p> still\nMine.", ["Mine."]),
        ("It was i.t Then we left.", ["It was it.", "Then we left."]),
        ("[img]http://x.invalid/1.png[/img] &amp;amp; [attachment deleted]", []),
    ],
)
def test_own_sentences(text, own):
    assert posts.sentences(text) == own


def test_addresses_and_features():
    assert posts.has_address("go to lucky-sh0p.example now") and posts.has_address("V1s1t http://x.y/z") and posts.has_address("qu1ck-g0ld.1nval1d?ref=3")
    assert not posts.has_address("It is done.Then we left, e.g. at 3.5 percent.")
    assert posts.features("The Pie-crust, 12 times") == ["the", "pie-crust", "0", "times", "the pie-crust", "pie-crust 0", "0 times"]
    assert "followers" in posts.features("f0ll0wers")


def test_votes_look_up_what_features_names():
    """All sentences at once, as one by one: words, pairs, numbers, disguises and tokens of several words."""
    lexicon = subjects.Lexicon(["law", "none"])
    rng = np.random.default_rng(1)
    lexicon.fill({t: rng.normal(0, 2, 2) for t in ("writ", "the writ", "0", "0 rd", "visit", "a-b", "é x", "court's", "writ 0")})
    texts = ["The writ, 12 of them.", "3rd writ 44", "V1s1t a-b", "É x and é  x", "court's plaintiff PLAINTIFF", "writ writ writ", "nothing here", "the. writ", "rd 0"]
    got = lexicon.votes(texts)
    for text, (seed, learned, _) in zip(texts, got.tolist(), strict=True):
        rows = [lexicon.rows[t] for t in set(posts.features(text)) if t in lexicon.rows]
        sums = lexicon.table[rows].sum(axis=0) if rows else np.zeros(5)
        assert seed == (1 if "plaintiff" in text.lower() else 0)
        assert learned == (0 if not sums[4] else 1 + int(sums[3] + 0.7 > sums[2])), text
    assert lexicon.votes([]).shape == (0, 3) and pickle.loads(pickle.dumps(lexicon)).votes(texts).tolist() == got.tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0.02, 0.98), max_size=9), st.integers(0, 6))
def test_at_least_so_many(chances, least):
    brute = 0.0
    for happens in itertools.product([0, 1], repeat=len(chances)):
        if sum(happens) >= least:
            brute += np.prod([p if h else 1 - p for p, h in zip(chances, happens, strict=True)])
    if abs(brute - 0.5) > 1e-9:
        assert subjects.likely_at_least(np.array(chances), least) == (brute >= 0.5)


def test_decision_by_posteriors():
    none = [0.0, 0.0, 1.0]
    rows = np.array([[1, 0, 0], none, none] + [none] + [[0.6, 0.4, 0], [0.3, 0.7, 0], none] + [[0.45, 0.45, 0.1]] * 3 + [[0, 0.4, 0.6], none])
    assert subjects.decide(np.array([3, 0, 1, 3, 3, 2]), rows, 1 / 3) == [(0, 0), (3, 0), (3, 1), (4, 0), (4, 1)]
    assert subjects.decide(np.array([0, 0]), np.zeros((0, 3)), 1 / 3) == []
    many = np.tile([[0.4, 0.2, 0.4]], (30_000, 1))
    assert subjects.decide(np.array([30_000]), many, 1 / 3) == [(0, 0)]


def test_the_labelled_sample_is_bounded(spark):
    documents = spark.createDataFrame([(i, "x" * 100) for i in range(50)] + [(7, "x" * (i % 50)) for i in range(300)] + [(60, None), (61, "y")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, s) for i in range(50) for s in ("law", "law", "none")] + [(60, "law"), (61, None)], "doc_id long, subject string")
    taken = lambda **o: subjects.labelled_sample(documents, labels, subjects.Options(**o))
    assert len(taken()) == 51 and len(taken(most_labelled=7)) == 7
    few = taken(most_labelled_bytes=1_050)
    assert sum(len(r["text"] or "") for r in few) <= 1_050 and len(few) >= 10
    assert sorted(r["subjects"] for r in few)[-1] == ["law", "none"] or sorted(few[0]["subjects"]) == ["law", "none"]


def test_hot_threads_take_another_path_to_the_same(spark, monkeypatch):
    documents, labels, areas, _ = corpus(spark, 60)
    plain = sorted(map(tuple, subjects.assign_subjects(documents, labels, areas).collect()), key=repr)
    monkeypatch.setattr(subjects, "lookup", lambda rows, side, key, columns: skew.lookup(rows, side, key, columns, hot_rows=4, most=2))
    assert sorted(map(tuple, subjects.assign_subjects(documents, labels, areas).collect()), key=repr) == plain


def test_a_very_long_post_is_read_whole():
    text = "A word here. " * 50_000 + "The end."
    assert posts.sentences(text)[-1] == "The end." and len(posts.sentences(text)) == 50_001


def test_the_latent_model_learns_who_is_right():
    """Votes drawn with known accuracies; the model must beat the majority vote and rank the functions."""
    rng = np.random.default_rng(3)
    k, n = 4, 20_000
    truth = rng.choice(k, n, p=[0.2, 0.2, 0.2, 0.4]) + 1
    accuracy, silent = [0.9, 0.6, 0.95, 0.9, 0.5, 0.3], [0.5, 0.5, 0.4, 0.95, 0.3, 0.1]
    votes = np.zeros((n, 6), int)
    for j in range(6):
        other = (truth - 1 + rng.integers(1, k, n)) % k + 1
        votes[:, j] = np.where(rng.random(n) < silent[j], 0, np.where(rng.random(n) < accuracy[j], truth, other))
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    posterior = subjects.fit_latent(patterns, counts.astype(float), k)
    assert np.allclose(posterior.sum(axis=1), 1)
    model = (posterior.argmax(axis=1) + 1)[inverse.ravel()]
    tally = np.stack([(votes == c).sum(axis=1) for c in range(1, k + 1)], axis=1)
    assert (model == truth).mean() > (tally.argmax(axis=1) + 1 == truth).mean() + 0.05


def corpus(spark, n=300):
    """Posts of two subjects with words the seeds don't know, small talk, and a passing remark in a few."""
    rng = np.random.default_rng(0)
    nouns = {"law": ["plaintiff", "bailiff", "writ", "tribunal"], "music": ["violin", "fretboard", "metronome", "quaver"]}
    talk = ["Thanks for reading.", "Same here.", "No idea why."]
    data, labels, truth = [], [], {}
    for i in range(n):
        s = ["law", "music"][i % 2]
        own = [f"The {rng.choice(nouns[s])} and the {rng.choice(nouns[s])} came again." for _ in range(4)]
        if i % 10 == 0:
            own.append(f"A {nouns['music' if s == 'law' else 'law'][1]} went by.")
        own.append(str(rng.choice(talk)))
        data.append((i, "Hi all,\n" + " ".join(own), i % 20, "board"))
        truth[i] = {s}
        labels.append((i, s if i % 17 else "none"))
    for i in range(n, n + 30):
        data.append((i, " ".join(rng.choice(talk, 2)), i % 20, "board"))
        truth[i] = set()
        labels.append((i, "none"))
    extra = [(1000, "Earn 5 a week at best-shop.example/x now.", 1, "b"), (1001, "", 1, "b"), (1002, None, None, None), (1003, "> The violin.", 1, "b"), (None, "The violin and the metronome.", 2, "b")]
    documents = spark.createDataFrame([(*r, "clash", 1) for r in data + extra], "doc_id long, text string, thread_id long, source string, tally string, n int")
    held = spark.createDataFrame([*[x for x in labels if x[0] % 3], (5, "law"), (5, "music"), (None, "law"), (7, None)], "doc_id long, subject string")
    areas = spark.createDataFrame([("law", "d"), ("music", "d"), ("none", "d"), (None, "d")], "subject string, description string")
    return documents, held, areas, truth


def test_posts_get_their_subjects(spark):
    documents, labels, areas, truth = corpus(spark)
    rows = subjects.assign_subjects(documents, labels, areas).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).add(r["subject"])
    right = sum(got.get(i, set()) == s for i, s in truth.items())
    assert right >= 0.97 * len(truth)
    assert not {1000, 1001, 1002, 1003} & got.keys() and got[None] == {"music"}


def test_without_labels_posts_or_subjects(spark):
    documents, labels, areas, _ = corpus(spark, 20)
    assert subjects.assign_subjects(documents.limit(0), labels, areas).count() == 0
    assert subjects.assign_subjects(documents, labels, areas.limit(0)).count() == 0
    seeds_only = {r["subject"] for r in subjects.assign_subjects(documents, labels.limit(0), areas).collect()}
    assert seeds_only <= {"law", "music"}
