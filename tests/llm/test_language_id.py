"""The network: gradients, determinism, held-out accuracy."""

import math

import numpy as np
import pytest

from helpers import document, table
from plumbline.llm import language_id
from plumbline.llm.language_id import Network, _gradients, fit, has_letter, held_out, identify, pooled, train
from plumbline.llm.queries import QUERIES


def test_gradients_are_the_slopes():
    draw = np.random.default_rng(0)
    network = Network.fresh(["a", "b", "c"], 4, 1)
    w = {name: x.astype(np.float64) for name, x in network.weights.items()}
    bytes_in = draw.integers(0, 256, (7, 5)).astype(np.uint8)
    bytes_in[5:, 2] = 0
    labels = draw.integers(0, 3, 5)
    found, _ = _gradients({n: x.astype(np.float32) for n, x in w.items()}, bytes_in, labels)
    for name, x in w.items():
        places = [int(np.abs(found[name]).argmax()), x.size // 2]
        for place in places:
            losses = []
            for step in (1e-2, -1e-2):
                moved = {n: y.copy() for n, y in w.items()}
                moved[name].flat[place] += step
                losses.append(_gradients({n: y.astype(np.float32) for n, y in moved.items()}, bytes_in, labels)[1])
            assert (losses[0] - losses[1]) / 2e-2 == pytest.approx(float(found[name].flat[place]), abs=2e-3)


def textbook(w, way, sequence):
    """States of a gated recurrent unit, one byte and one number at a time."""
    hidden = w["u" + way].shape[0]
    state, states = [0.0] * hidden, []

    def sigmoid(x):
        return 1 / (1 + math.exp(-x))

    for byte in sequence if way == "f" else reversed(sequence):
        entered = w["x" + way][byte]
        recalled = [sum(state[i] * w["u" + way][i][k] for i in range(hidden)) for k in range(3 * hidden)]
        update = [sigmoid(entered[k] + recalled[k]) for k in range(hidden)]
        reset = [sigmoid(entered[hidden + k] + recalled[hidden + k]) for k in range(hidden)]
        candidate = [
            math.tanh(entered[2 * hidden + k] + reset[k] * (recalled[2 * hidden + k] + w["b" + way][k])) for k in range(hidden)
        ]
        state = [update[k] * state[k] + (1 - update[k]) * candidate[k] for k in range(hidden)]
        states.append(state)
    return states if way == "f" else states[::-1]


def test_the_forward_pass_is_the_textbook_one():
    network = Network.fresh(["a", "b", "c"], 5, 7)
    for name in ("bf", "bb", "c"):
        network.weights[name][:] = np.random.default_rng(1).normal(0, 0.5, network.weights[name].shape)
    w, text = network.weights, "Übung, the text".encode()
    ahead, back = (textbook(w, way, text) for way in "fb")
    expected = np.zeros(3)
    for one, two in zip(ahead, back, strict=True):
        scores = np.array(one) @ w["vf"] + np.array(two) @ w["vb"] + w["c"]
        expected += np.exp(scores) / np.exp(scores).sum() / len(text)
    found = pooled(network, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
    assert found[0] == pytest.approx(expected, abs=1e-5)


def test_letters_are_those_of_unicode(spark, files):
    for text in ("½ ②", "²", "Ⅷ", "", "1_2", "٣"):
        assert not has_letter(text)
    for text in ("½a", "漢", "_é", "ª", "ß1"):
        assert has_letter(text)
    docs = files(table(spark, [document(1, "½ ② Ⅷ³"), document(2, "½ a")]))
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in identify(docs, Network.fresh(["en", "fr"], 8, 1)).collect()}
    assert found[1] == ("und", 0.0) and found[2][0] != "und"


def test_training_separates_two_alphabets():
    draw = np.random.default_rng(3)
    stretches = np.concatenate([draw.integers(97, 105, (150, 64)), draw.integers(103, 112, (150, 64))]).astype(np.uint8)
    labels = np.repeat([0, 1], 150)
    one, two = (train(stretches, labels, ["a", "b"], steps=60) for _ in range(2))
    assert all((one.weights[n] == two.weights[n]).all() for n in one.weights)
    texts = [bytes(draw.integers(low, low + 8, 900).astype(np.uint8)) for low in [97, 103] * 20]
    offsets = np.cumsum([0, *map(len, texts)])
    found = pooled(one, np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert found.sum(axis=1) == pytest.approx(1, abs=1e-4)
    assert (found.argmax(axis=1) == np.array([0, 1] * 20)).mean() >= 0.95


def test_pooling_does_not_depend_on_neighbours(monkeypatch):
    network = Network.fresh(["a", "b"], 8, 2)
    texts = [b"x" * n for n in (1, 127, 128, 129, 1000, 0, 5)]
    offsets = np.cumsum([0, *map(len, texts)])
    together = pooled(network, np.frombuffer(b"".join(texts), np.uint8), offsets)
    for i, text in enumerate(texts):
        alone = pooled(network, np.frombuffer(text, np.uint8), np.array([0, len(text)]))
        assert together[i] == pytest.approx(alone[0], abs=1e-5)
    monkeypatch.setattr(language_id, "LANES", 3)
    assert pooled(network, np.frombuffer(b"".join(texts), np.uint8), offsets) == pytest.approx(together, abs=1e-5)


def test_held_out_accuracy(spark, sf_dir):
    found = QUERIES["op4_language_id"](spark, sf_dir)
    truth = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(truth, "doc_id").filter("held_out").collect()
    assert len(rows) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) >= 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_odd_documents(odd, crowded):
    network = Network.fresh(["en", "fr"], 8, 1)
    found = identify(crowded, network, ["doc_id", "text"], "doc_id long, text string").collect()
    assert len(found) == odd.count()
    for r in found:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] != "und") == letters and (letters or r["score"] == 0)
    assert len({(r["lang_pred"], r["score"]) for r in found if r["doc_id"] == 4}) == 1


def test_nothing_to_learn_from(odd, none):
    network = fit(odd.filter("lang IS NULL"), ~held_out())
    assert {r["lang_pred"] for r in identify(odd, network).collect()} == {"und"}
    assert identify(none, fit(none, ~held_out())).count() == 0


def test_labels_of_held_out_rows_are_not_used(spark, files):
    rows = [document(i, f"alpha beta {i}", "en") for i in range(60)]
    docs = files(table(spark, rows))
    import zlib

    out = [i for i in range(60) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sorted(r["doc_id"] for r in docs.filter(held_out()).collect()) == out
    assert fit(docs.filter(held_out()), ~held_out()).languages == []
