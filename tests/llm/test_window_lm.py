import math
import random

import numpy as np
import pytest

from newsloom.llm import window_lm as L

SCHEMA = "doc_id long, text string"


@pytest.fixture(autouse=True, scope="module")
def folder(spark, tmp_path_factory):
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))


def corpus(words, n=300, seed=3):
    rng, rows = random.Random(seed), []
    for i in range(n):
        line, word = [], 0
        for _ in range(rng.randint(1, 60)):  # words follow each other by a rule, with some noise
            word = (word * 3 + 1) % words if rng.random() < 0.8 else rng.randrange(words)
            line.append(f"w{word}xyz" if rng.random() < 0.9 else f"rare{rng.randint(0, 10**6)}x")
        rows.append((i, " ".join(line)))
    return rows


def scores(spark, rows):
    return {r.doc_id: r for r in L.score_documents(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()}


def test_words_with_one_ending_have_scores_of_their_own(spark):
    rows = corpus(500) + [(1000, "w1xyz qqqqxyz w2xyz"), (1001, "w1xyz rare12xyz w2xyz"), (1002, "often1xyz"), (1003, "seldom1xyz")]
    rows += [(2000 + i, "often1xyz often1xyz") for i in range(40)] + [(3000 + i, "seldom1xyz") for i in range(5)]
    got = scores(spark, rows)
    assert got[1000].log_prob != got[1001].log_prob
    assert got[1002].log_prob != got[1003].log_prob


def test_vocabulary_and_classes_grow_with_the_corpus(spark):
    few, many = (L.vocabulary(spark.createDataFrame(corpus(k, 2000), SCHEMA)) for k in (100, 4000))
    assert len(few.words) == 100 and len(many.words) > 3000
    assert L.classes(many)[0].max() > L.classes(few)[0].max()
    total = sum(len(t.split()) for _, t in corpus(100, 2000))
    assert few.counts.sum() + few.rest == total


def test_probabilities_sum_to_one(spark):
    rows = corpus(300)
    texts = [t.encode() for _, t in rows]
    known = L.vocabulary(spark.createDataFrame(rows, SCHEMA))
    of, share = L.classes(known)
    assert np.allclose(np.bincount(of[1:], np.exp(share[1:])), 1)
    assert np.allclose(np.exp(known.spelling).sum(axis=1), 1)
    net = L.started(texts, known, of)
    row = np.array([2, 3, 0, 4, 5])  # the sum over all that may stand between four neighbours
    total = 0.0
    for i in range(1, len(of)):
        row[2] = i
        total += np.exp(net.log_chances(row, of)[1][0] + share[i])
    assert abs(total - 1) < 1e-4


def test_step_follows_the_gradient(spark):
    known = L.Vocabulary([b"a", b"b", b"c"], np.array([5, 4, 3]), 2, L.spelling_of(np.zeros(256 * 256)))
    of, _ = L.classes(known)
    net = L.new_network(known, of)
    row = np.array([0, 0, 2, 3, 1, 4, 3, 0, 0])
    # the first step of this rule moves each value by the rate against the sign of its gradient
    loss = lambda n: -n.log_chances(row, of)[1].mean()
    for k, index in ((0, (1, 3, 5)), (1, (4,)), (2, (3, 1)), (3, (2,)), (4, (0, 2, 1)), (5, (0, 1))):
        up, down, moved = net.copy(), net.copy(), net.copy()
        up.dense[k][index] += 1e-2
        down.dense[k][index] -= 1e-2
        moved.step(row, of)
        assert np.sign(moved.dense[k][index] - net.dense[k][index]) == -np.sign(loss(up) - loss(down))


def test_the_network_beats_single_words_and_prefers_the_right_order(spark):
    rows = corpus(17)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    known = L.vocabulary(df)
    of, share = L.classes(known)
    net = L.train(df, known, of)
    numbers, rng, better = L.numbers_of(known.words), random.Random(1), 0
    n = np.concatenate([[known.rest], known.counts])
    alone = np.log(n / n.sum())
    row, _, _ = L.numbered([t.encode() for _, t in rows], numbers)
    _, chance = net.log_chances(row, of)
    tokens = row[row > 0]
    assert (chance + share[tokens]).mean() > alone[tokens - 1].mean() + 0.3
    long = [t for _, t in rows if len(t.split()) > 30]
    for t in long:
        mixed = t.split()
        rng.shuffle(mixed)
        _, (a, b) = L.score_texts([t.encode(), " ".join(mixed).encode()], numbers, of, share, known.spelling, net)
        better += a > b
    assert better > 0.9 * len(long)


def token_by_token(text, known, of, share, net):
    """The score of one text from the values of the network, in plain arithmetic."""
    words = text.encode().lower().split()
    ids = [known.words.index(w) + 2 if w in known.words else 1 for w in words]
    place, base, groups, group_base, members, member_base = (d.tolist() for d in net.dense)
    dot = lambda h, matrix, j: sum(h[i] * matrix[i][j] for i in range(len(h)))
    total = 0.0
    for t, word in enumerate(words):
        h = list(base)
        for p, step in enumerate((-2, -1, 1, 2)):
            z = net.rows[ids[t + step] if 0 <= t + step < len(ids) else 0].tolist()
            h = [h[j] + dot(z, place[p], j) for j in range(len(h))]
        h = [math.tanh(x) for x in h]
        g, m = net.group[of[ids[t]]], net.member[of[ids[t]]]
        for matrix, bases, right in ((groups, group_base, g), (members[g], member_base[g], m)):
            outputs = [dot(h, matrix, j) + bases[j] for j in range(len(bases))]
            total += outputs[right] - math.log(sum(math.exp(x) for x in outputs))
        total += share[ids[t]]
        if ids[t] == 1:
            spelled = b" " + word + b" "
            total += sum(known.spelling[a, b] for a, b in zip(spelled, spelled[1:], strict=False))
    return total


def test_scores_are_those_of_one_token_after_the_other(spark, monkeypatch):
    rows = corpus(60, 120) + [(1000, ""), (1001, "w1xyz"), (1002, "é w1xyz unseen"), (1003, None)]
    df, seen, train = spark.createDataFrame(rows, SCHEMA).repartition(3), [], L.train
    monkeypatch.setattr(L, "train", lambda docs, known, of, tokens: seen.append((known, of, train(docs, known, of, tokens))) or seen[-1][2])
    got = {r.doc_id: r for r in L.score_documents(df).collect()}
    known, of, net = seen[0]
    share = L.classes(known)[1]
    assert len(got) == len(rows)
    for i, text in rows:
        assert got[i].n_tokens == len((text or "").split())
        assert got[i].log_prob == pytest.approx(token_by_token(text or "", known, of, share, net), rel=1e-4, abs=1e-4)


def test_changes_of_tasks_are_averaged_by_weight_in_any_number_of_turns():
    known = L.Vocabulary([f"w{i}".encode() for i in range(1500)], np.arange(1500, 0, -1), 2, L.spelling_of(np.zeros(256 * 256)))
    of, _ = L.classes(known)
    start, rng, tasks = L.new_network(known, of), np.random.default_rng(5), []
    for n in (10, 30, 60):
        net, met = start.copy(), rng.integers(0, 3, len(of)).astype(float)
        net.rows += rng.normal(0, 1, net.rows.shape).astype(np.float32)
        for d in net.dense:
            d += np.float32(n)
        tasks.append((net, met, n))
    sent = [L._record(list(L.changes(net, start, met, n))) for net, met, n in tasks]
    weight = sum(met for _, met, _ in tasks)
    want = sum(met[:, None] * (net.rows - start.rows) for net, met, _ in tasks) / np.maximum(weight, 1)[:, None]
    for merged in (L.average(iter(sent)), L.average(iter([*L.average(iter(sent[:2])), sent[2]]))):
        got, dense = np.zeros_like(want), []
        for r in (r for b in merged for r in b.to_pylist()):
            at, value = np.frombuffer(r["at"], np.uint16), np.frombuffer(r["value"], np.float16).reshape(-1, L.EMBEDDING)
            if r["block"] >= 0:
                got[r["block"] * L.BLOCK + at] = value
            else:
                dense.append(value[:1])
        assert np.allclose(got, want, atol=5e-3)
        assert dense and np.allclose(dense, (100 + 900 + 3600) / 100, rtol=2e-3)


def test_the_sample_reaches_the_ends_of_long_texts(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60_000))
    monkeypatch.setattr(L, "SAMPLE", 6_000)
    pieces = L._sample(spark.createDataFrame([(i, text) for i in range(3)] + [(9, None), (10, "")], SCHEMA), 180_000)
    numbers = [int(w[1:]) for p in pieces for w in p.split()[1:-1]]
    assert 1_000 < len(numbers) < 20_000 and max(numbers) > 30_000 > min(numbers)


def test_odd_rows(spark):
    assert L.score_documents(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = L.score_documents(spark.createDataFrame([(1, None)], SCHEMA)).collect()
    assert (row.n_tokens, row.log_prob, row.mean_log_prob) == (0, 0.0, None)
    got = scores(spark, [(1, "W1 w1 \n w1 w1 w1"), (2, "y" * 70_000), (3, ""), (4, "é ü"), (5, "w1 w1 w1 w1 w1")])
    assert [got[i].n_tokens for i in (1, 2, 3, 4, 5)] == [5, 1, 0, 2, 5]
    assert got[1].log_prob == got[5].log_prob and all(np.isfinite(r.log_prob) for r in got.values())
