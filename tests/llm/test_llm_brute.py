"""Quality statistics, trees and the counted transcript model against plain loops."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskweave.llm import chat_format, quality

TEXTS = [
    "", " ", "\n\n", "a", "Hello, World. THIS IS IT!!", "tab\tand\x0bvertical\x0c 12 345 , . ,,", "same same same\nsame same\nsame same",
    "größer Straße: ÄÖÜ ñandú 日本語 テキスト", "$$$ #win @you x- y* (z) \"q\"", "A\r\nB\r\nA\r\n" * 40, "word " * 5000 + "End.", "\x00\x01\x7f ÿ",
]


def plain_statistics(text):
    raw = text.encode()
    if not raw:
        return [0.0] * len(quality.FEATURES)
    words, word = [], bytearray()
    for b in raw + b" ":
        if b in b" \t\n\x0b\x0c\r":
            if word:
                words.append(bytes(word))
            word = bytearray()
        else:
            word.append(b)
    lines, n, m = raw.split(b"\n"), len(raw), len(words)
    of = lambda test: sum(1 for b in raw if test(b)) / n
    letter = lambda b: chr(b).isalnum() and b < 128
    marks = [b for b in range(33, 127) if not chr(b).isalnum()]
    share = lambda test: sum(1 for w in words if test(w)) / m if m else 0.0
    return [
        math.log(1 + n), math.log(1 + m), math.log(1 + len(lines)), n / (m + 1),
        of(lambda b: 65 <= b <= 90), of(lambda b: 97 <= b <= 122), of(lambda b: 48 <= b <= 57), of(lambda b: b in b" \t\n\x0b\x0c\r"), of(lambda b: b >= 128),
        of(lambda b: b == 44), of(lambda b: b == 46), of(lambda b: b in marks and b not in (44, 46)), max(raw.count(bytes([b])) for b in marks) / n,
        len(set(words)) / m if m else 0.0, sum(a == b for a, b in zip(words, words[1:])) / m if m else 0.0,
        max(Counter(words).values()) / m if m else 0.0,
        share(lambda w: len(w) > 1 and any(65 <= b <= 90 for b in w) and not any(97 <= b <= 122 for b in w)),
        share(lambda w: w[-1] < 128 and not letter(w[-1]) and w[-1] not in b".,;:!?)\"'"), share(lambda w: w[0] < 128 and not letter(w[0])),
        m / len(lines) if m else 0.0, len(set(lines)) / len(lines) if m else 0.0, share(lambda w: len(w) <= 2),
        -sum(k / n * math.log2(k / n) for k in Counter(raw).values()), share(lambda w: 65 <= w[0] <= 90),
    ]


@pytest.mark.parametrize("text", TEXTS)
def test_statistics_are_those_of_plain_loops(text):
    got = dict(zip(quality.FEATURES, quality.statistics(text.encode()), strict=True))
    assert got == pytest.approx(dict(zip(quality.FEATURES, plain_statistics(text), strict=True)), abs=1e-12)


def plain_boosting(x, y, n_trees, depth, bins, rate, least, ridge):
    """Margins of trees grown by trying every cut on the rows themselves."""
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    share = y.mean()
    out = np.full(len(y), math.log((share + 1e-6) / (1 - share + 1e-6)))

    def grow(rows, g, h, level):
        best, parts = 1e-6, None
        whole = g[rows].sum() ** 2 / (h[rows].sum() + ridge)
        if level < depth:
            for f, c in ((f, c) for f in range(x.shape[1]) for c in cuts[f]):
                left, right = rows[x[rows, f] <= c], rows[x[rows, f] > c]
                if min(len(left), len(right)) >= least:
                    gain = sum(g[s].sum() ** 2 / (h[s].sum() + ridge) for s in (left, right)) - whole
                    if gain > best + 1e-9:
                        best, parts = gain, (left, right)
        if parts is None:
            out[rows] -= rate * g[rows].sum() / (h[rows].sum() + ridge)
        else:
            for part in parts:
                grow(part, g, h, level + 1)

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-out))
        grow(np.arange(len(y)), p - y, p * (1 - p), 0)
    return out


@pytest.mark.parametrize("depth", [1, 3])
def test_trees_are_those_of_trying_every_cut(depth):
    rng = np.random.default_rng(depth)
    x = np.column_stack([rng.normal(size=400), rng.integers(0, 4, 400), rng.normal(size=400).round(1)])
    y = (x[:, 0] + 0.6 * (x[:, 1] > 1) * x[:, 2] + 0.5 * rng.normal(size=400) > 0.4).astype(float)
    how = {"n_trees": 8, "depth": depth, "bins": 16, "rate": 0.3, "least": 9, "ridge": 0.5}
    trees = quality.fit_trees(x, y, **how)
    assert np.allclose(trees.score(x), 1 / (1 + np.exp(-plain_boosting(x, y, **how))), atol=1e-9)


def test_the_flattened_walk_is_a_walk_row_by_row():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(500, 4))
    trees = quality.fit_trees(x, (x[:, 0] * x[:, 1] > 0).astype(float), n_trees=12)
    fresh = np.vstack([rng.normal(size=(200, 4)) * 3, [[np.inf] * 4, [-np.inf] * 4, [0.0] * 4]])
    fresh[:20, 1] = trees.threshold[np.isfinite(trees.threshold)][:20]  # values right at a threshold
    for row, score in zip(fresh, trees.score(fresh), strict=True):
        total = trees.base
        for root in trees.roots:
            at = root
            while trees.left[at] != at:
                at = trees.left[at] + int(row[trees.feature[at]] > trees.threshold[at])
            total += trees.value[at]
        assert score == pytest.approx(1 / (1 + math.exp(-total)))


def test_the_transcript_model_is_counted_from_the_taught_turns(spark):
    rows = [
        *[(c, t, ("system", "user", "assistant", "user")[t], f"turn {t}?\nline\n\nend {c}" if (c + t) % 3 else f"turn {t}.") for c in range(40) for t in range(4)],
        (50, 0, "user", None), (51, 0, "other", "text"), (None, 0, "user", "text"), (52, 0, "user", ""), (53, 3, "assistant", "late\n"),
        (54, 0, "user", "twice"), (54, 0, "user", "twice\nlines"), (54, 1, "assistant", "x"), (55, None, "user", "no place"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = [r for r in chat_format.written(frame).collect() if r["role"] in chat_format.ROLES and r["text"] is not None]
    turns = [r for r in turns if r["conv_id"] is not None and zlib.crc32(str(r["conv_id"]).encode()) % 3 != 1]
    before = defaultdict(list)
    for r in turns:
        if r["part"] is not None:
            before[r["conv_id"], r["part"] + 1].append(r)
    S = chat_format.STATES
    step, emit = np.full((S + 1, S), 0.5), [np.full((S, v), 0.5) for v in chat_format.VALUES]
    for a in range(S + 1):
        for b in (1, 3, 5):
            step[a, b] = 0.5 if a in (b - 1, b) else 0.0
    for r in turns:
        lines, state = r["text"].split("\n"), 2 * chat_format.ROLES.index(r["role"])
        earlier = before[r["conv_id"], r["part"]]
        role = min((e["role"] for e in earlier), default=None)
        came = chat_format.START if role is None else 2 * chat_format.ROLES.index(role) + any("\n" in e["text"] for e in earlier)
        for i, seen in enumerate(chat_format.observed(lines)):
            now = state + (i > 0)
            step[came, now] += 1
            came = now
            for table, value in zip(emit, seen, strict=True):
                table[now, value] += 1
    model = chat_format.learn_from_conversations(frame)
    with np.errstate(divide="ignore"):
        assert np.allclose(model.step, np.log(step / step.sum(axis=1, keepdims=True)))
        assert all(np.allclose(m, np.log(e / e.sum(axis=1, keepdims=True))) for m, e in zip(model.emit, emit, strict=True))
