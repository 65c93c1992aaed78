import random
import zlib

import pytest
from cases import frame, odd_rows

from riskloom.llm import toxicity as X

BAD = ("grumblefoot", "nastyling", "vileworth")


def corpus(n=900, seed=1):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("aeioulmnrst") for _ in range(r.randint(3, 7))) for _ in range(400)]
    rows, labels = [], []
    for d in range(n):
        said = [" ".join(r.choice(vocabulary) for _ in range(r.randint(3, 10))) for _ in range(r.randint(1, 12))]
        toxic = d % 6 == 0
        if toxic:
            i = r.randrange(len(said))
            said[i] += " " + r.choice(BAD)
        rows.append((d, ". ".join(said) + "."))
        labels.append((d, 1, int(toxic)))
    return rows, labels


def scores(spark, rows, labels, **options):
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return X.score_toxicity(frame(spark, rows), table, **options)


def test_held_out_documents_and_their_sentences(spark):
    rows, labels = corpus()
    got = {r.doc_id: r for r in scores(spark, rows, labels).collect()}
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, _ in rows)
    held = [d for d, _ in rows if got[d].held_out]
    assert all(got[d].predicted == int(d % 6 == 0) for d in held)
    texts = dict(rows)
    for d in held:
        found = [texts[d][s.start:s.end] for s in got[d].offending]
        assert len(found) == (d % 6 == 0) and all(any(b in s for b in BAD) for s in found)
        assert 0 <= got[d].score <= 1 and got[d].predicted == (got[d].score >= 0.5)


def test_noisy_or_joins_the_sentences():
    import numpy as np

    model = X.NoisyOr({"bad": 3.0, "wor-": 1.0}, -2.0)
    p = model.probabilities(X.sentences("A bad bad day! worse, words\nfine"))
    assert p == pytest.approx(1 / (1 + np.exp(-np.array([1.0, -2.0, -2.0]))))
    assert model.either(p) == pytest.approx(1 - np.prod(1 - p)) and model.either(p[:0]) == 0
    assert X.NoisyOr({"worse": 1.0, "wors-": 1.0}, 0.0).probabilities(X.sentences("Worse worse"))[0] == pytest.approx(1 / (1 + np.exp(-2.0)))


def test_sample_is_bounded_and_leaves_the_fold_out(spark):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    sample = X.training_sample(frame(spark, rows), table, 100, 10_000).collect()
    held = {t for d, t in rows if zlib.crc32(str(d).encode()) % 5 == 0}
    assert len(sample) == 100 and not any(r.text in held for r in sample)
    assert X.training_sample(frame(spark, rows), table, 100, 5).count() == 0


def test_odd_rows_and_labels(spark):
    rows, labels = corpus(300)
    more = [(d if d is None else d + 5000, t) for d, t in odd_rows()]
    odd_labels = labels + [(None, 1, 1), (1, None, None), (5004, 1, 0), (77, 0, 0), (77, 0, 0)]
    out = scores(spark, rows + more, odd_labels, keep_text=True)
    got = out.collect()
    assert len(got) == len(rows) + len(more)
    assert all(r.score == 0 and r.predicted == 0 and r.offending == [] for r in got if not (r.rest.text or "").strip())
    assert sorted(((r.doc_id, r.rest.text) for r in got), key=repr) == sorted(rows + more, key=repr) and got[0].rest.key == "y"
    assert all(not r.held_out for r in got if r.doc_id is None)


def test_nothing_to_learn_from(spark):
    rows, _ = corpus(20)
    for labels in ([], [(d, 1, 0) for d, _ in rows]):
        assert all(r.score < 1e-6 and not r.predicted for r in scores(spark, rows, labels).collect())
    assert scores(spark, [], []).collect() == []
