"""Packing, quality, n-gram join, suffix dedup and chat against brute force."""

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_fixtures import DOCS, ODD_DOCS, SF001, SF0001, no_docs, odd_docs
from tokenizers import Tokenizer

from riskweave.llm import chat_format, ngram_join, packing, quality, queries, suffix_dedup

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)


def ids_of(text):
    return np.array([*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")


def test_other_vocabularies_encode_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    words = packing.WordIds(path)
    texts = ["Some Text, with  blanks", "", "É à\n\n x"]
    assert not words.by_word and packing.word_ids(PATH).by_word
    plain = Tokenizer.from_file(path)
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="aAbZé\u0301's,.!?;:<|endoftext|> \n\t\x1cΣİI19²…", max_size=60), max_size=5))
def test_word_ids_are_those_of_the_whole_text(texts):
    words = packing.word_ids(PATH)
    for text, ids in zip(texts, words.encode([t.encode() for t in texts]), strict=True):
        assert ids.tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


def test_forgotten_words_are_learnt_again(monkeypatch):
    monkeypatch.setattr(packing, "KEPT_WORDS", 50)
    words = packing.WordIds(PATH)
    for i in range(20):
        text = " ".join(f"word{j} Thing{j}," for j in range(i * 3, i * 3 + 25))
        assert words.encode([text.encode(), b""])[0].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 30), max_size=20))
def test_windows_use_up_all_counts(counts):
    plan = packing.plan_windows(counts, 64)
    used = Counter()
    for window, times in plan:
        assert times > 0 and sum(x * n for x, n in window.items()) <= 64
        for x, n in window.items():
            used[x] += n * times
    assert used == Counter(counts)


def test_window_is_as_full_as_it_can_be():
    assert packing.fill_window({5: 2, 3: 1, 7: 1}, 6, 16) in ({6: 1, 5: 2}, {6: 1, 3: 1, 7: 1})
    assert sum(x * n for x, n in packing.fill_window({9: 1, 4: 3, 2: 1}, 7, 20).items()) == 20


def check_packing(rows, docs, capacity=4096):
    totals = rows.groupby("sequence_id")["length"].sum()
    assert totals.max() <= capacity
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id")["length"].cumsum() - rows["length"] == rows["offset"]).all()
    expected = Counter()
    for doc_id, text in docs:
        ids = ids_of(text)
        for s in range(0, len(ids), capacity):
            piece = ids[s : s + capacity]
            expected[(doc_id, s, len(piece), zlib.crc32(piece.tobytes()), len(ids))] += 1
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    got = rows[columns].astype(object).where(rows[columns].notna(), None)
    assert Counter(tuple(None if x is None else int(x) for x in r) for r in got.itertuples(index=False)) == expected
    return sum(packing.padding(int(t), capacity) for t in totals)


def test_packing_whole_table(spark):
    docs = pd.read_parquet(f"{SF001}/documents.parquet")
    rows = queries.QUERIES["op5_packing"](spark, SF001).toPandas()
    padded = check_packing(rows, zip(docs["doc_id"], docs["text"], strict=True))
    assert padded <= 0.01 * rows["length"].sum()


def test_packing_odd_rows(spark):
    check_packing(packing.pack(odd_docs(spark), tokenizer=PATH).toPandas(), [r[:2] for r in ODD_DOCS])
    assert packing.pack(no_docs(spark), tokenizer=PATH).count() == 0


def test_quality_on_held_out_rows(spark):
    rows = queries.QUERIES["op6_quality"](spark, SF001).toPandas()
    assert len(rows) == 1000 and rows["score"].between(0, 1).all()
    assert (rows["held_out"] == [zlib.crc32(str(i).encode()) % 3 == 1 for i in rows["doc_id"]]).all()
    assert (rows["predicted"] == (rows["score"] >= 0.5)).all()
    test = rows[rows["held_out"]].merge(pd.read_parquet(f"{SF001}/labels.parquet"), on="doc_id")
    assert (test["predicted"] == test["quality"]).mean() > 0.95


def test_quality_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, None, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = quality.classify(odd_docs(spark), labels).collect()
    assert len(rows) == len(ODD_DOCS) and all(0 <= r["score"] <= 1 for r in rows)
    assert quality.classify(no_docs(spark), labels).count() == 0
    assert quality.classify(odd_docs(spark), labels.limit(0)).first()["score"] == 0.5
    kept = quality.keep_good(odd_docs(spark), labels)
    assert kept.schema == odd_docs(spark).schema and kept.count() == len(ODD_DOCS)


def test_stage_learns_although_most_labels_are_of_other_rows(spark):
    texts = ["buy now!!! $$$ 123 456 ### win", "The river runs slowly past the old mill, and the people of the town walk there."]
    docs = spark.createDataFrame([(i, f"{texts[i % 2]} {i % 7}", "en", "s", 9) for i in range(300)], DOCS)
    labels = spark.range(60_000).selectExpr("id as doc_id", "int(id % 2) as quality", "0 as toxic")
    kept = quality.keep_good(docs, labels, max_rows=100).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == list(range(1, 300, 2))


def test_trees_separate_what_can_be_separated():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(4000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 2] < -0.2)).astype(float)
    trees = quality.fit_trees(x[:3000], y[:3000])
    assert ((trees.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.97


def sets_of(docs, k):
    out = {}
    for doc_id, text in docs:
        words = (text or "").encode().lower().split()
        grams = frozenset(zip(*[words[i:] for i in range(k)], strict=False)) if len(words) >= k else frozenset([tuple(words)] if words else [])
        out[doc_id] = grams
    return out


def groups_of(sets, num, den):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for i, s in sets.items():
        both = Counter(j for g in s for j in where[g] if j < i)
        for j, n in both.items():
            if den * n >= num * (len(s) + len(sets[j]) - n):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_ngram_join_whole_table(spark):
    docs = pd.read_parquet(f"{SF0001}/documents.parquet")
    sets = sets_of(zip(docs["doc_id"], docs["text"], strict=True), 3)
    groups = groups_of(sets, 90, 100)
    rows = queries.QUERIES["op1_ngram_join"](spark, SF0001).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert (r["n_shingles"], r["component_id"]) == (len(sets[r["doc_id"]]), groups[r["doc_id"]])


def near_copies(n, words, rng):
    base = [f"w{i}" for i in range(words)]
    out = []
    for i in range(n):
        text = list(base)
        for at in rng.integers(0, words, rng.integers(0, 7)):
            text[at] = f"x{rng.integers(0, 1000)}"
        out.append((i, " ".join(text)))
    return out


def test_near_copies_in_tiles(spark, monkeypatch):
    docs = near_copies(150, 120, np.random.default_rng(2)) + [(500 + i, f"alone {i} word") for i in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    for k, num in ((3, 90), (5, 80)):
        groups = groups_of(sets_of(docs, k), num, 100)
        assert len(set(groups.values())) > 25
        for tile in (1_000_000, 3000):  # the second cuts the cluster into tiles
            monkeypatch.setattr(ngram_join, "TILE_SHINGLES", tile)
            rows = ngram_join.similar_documents(frame, k=k, num=num, den=100).collect()
            assert {r["doc_id"]: r["component_id"] for r in rows} == groups


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(3)
    for num in (90, 80):
        bands = ngram_join.Bands(num, 100)
        for _ in range(400):
            n = int(rng.integers(1, 900))
            a = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2))
            inter = int(rng.integers(num * len(a) // 100, len(a) + 1))
            most = inter * 100 // num  # of the union
            b = np.concatenate([rng.choice(a, inter, replace=False), rng.integers(0, 1 << 63, max(0, most - len(a)), dtype=np.uint64) | np.uint64(1)])
            b = np.unique(b)
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= num * (len(a) + len(b) - both):
                (x, cx), (y, cy) = ngram_join.signatures(a, bands), ngram_join.signatures(b, bands)
                _, i, j = np.intersect1d(x, y, return_indices=True)
                band, n = np.unique(cx[i] >> 20, return_counts=True)
                need = [max(int(cx[i][cx[i] >> 20 == t].max()), int(cy[j][cy[j] >> 20 == t].max())) & 0xFFFFF for t in band]
                assert any(n >= need)


def test_ngram_join_odd_rows(spark):
    rows = ngram_join.similar_documents(odd_docs(spark), k=3, num=90, den=100).collect()
    assert len(rows) == len(ODD_DOCS)
    of = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert of[2] == (10, 1) and of[3] == (0, 3) and of[4] == (0, 4) and of[5] == (0, 5)
    assert of[6] == (3, 6) and of[7] == (1, 7) and of[None][1] is None
    assert ngram_join.similar_documents(no_docs(spark)).count() == 0
    kept = sorted(str(r["doc_id"]) for r in ngram_join.one_of_each_group(odd_docs(spark)).collect())
    assert kept == sorted(["1", "3", "4", "5", "6", "7", "7", "8", "None"])


def cut(docs, length):
    raws = [(i, (t or "").encode()) for i, t in docs]
    seen = Counter(r[s : s + length] for _, r in raws for s in range(len(r) - length + 1))
    out = []
    for i, r in raws:
        gone = np.zeros(len(r) + 2, dtype=np.int64)
        for s in range(len(r) - length + 1):
            if seen[r[s : s + length]] > 1:
                gone[s + 1 : s + 1 + length] = 1
        kept = bytes(b for b, g in zip(r, gone[1:-1], strict=True) if not g)
        out.append((i, len(r), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return Counter(out)


COLUMNS = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]


def test_suffix_dedup_whole_table(spark):
    docs = pd.read_parquet(f"{SF0001}/documents.parquet")
    out = queries.QUERIES["op3_suffix_dedup"](spark, SF0001)
    assert Counter(map(tuple, out.select(*COLUMNS).collect())) == cut(zip(docs["doc_id"], docs["text"], strict=True), 400)
    texts = dict(zip(docs["doc_id"], docs["text"], strict=True))
    for r in out.collect():
        assert r["n_kept"] == r["n_bytes"] - r["n_removed"]
        if not r["n_removed"]:
            assert r["kept"] == (texts[r["doc_id"]] or "")
        elif "\ufffd" not in r["kept"]:
            assert hashlib.sha256(r["kept"].encode()).hexdigest() == r["kept_sha256"]


@pytest.mark.parametrize(("hot", "at_once"), [(4096, 1 << 20), (3, 1 << 20), (3, 2_000)])
def test_suffix_dedup_of_overlapping_passages(spark, monkeypatch, hot, at_once):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    monkeypatch.setattr(suffix_dedup, "SORT_BYTES", at_once)  # small: many sorts in a task
    rng = np.random.default_rng(4)
    passages = ["".join(rng.choice(list("abcé \n"), rng.integers(100, 700))) for _ in range(6)]
    docs = []
    for i in range(40):
        parts = [passages[j] for j in rng.integers(0, 6, rng.integers(0, 4))] + ["".join(rng.choice(list("xyzw"), rng.integers(0, 300)))]
        text = "".join(parts)
        if i % 5 == 0 and len(text) > 50:
            text = text[:40] + "#" + text[41:]
        docs.append((i, text))
    docs += [(100, "a" * 1000), (101, "ab" * 400), (102, docs[3][1]), (103, None), (104, ""), (100, "a" * 1000), (None, docs[4][1] + "tail")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    rows = suffix_dedup.remove_repeats(frame, length=128).select(*COLUMNS).collect()
    assert Counter(map(tuple, rows)) == cut(docs, 128)


def test_suffix_dedup_odd_rows(spark):
    rows = suffix_dedup.remove_repeats(odd_docs(spark), length=400).select(*COLUMNS).collect()
    assert Counter(map(tuple, rows)) == cut([r[:2] for r in ODD_DOCS], 400)
    assert suffix_dedup.remove_repeats(no_docs(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), min_size=2, max_size=120))
def test_two_stage_order_is_the_order_of_suffixes(symbols):
    text = np.array([*symbols, 0], dtype=np.uint16)
    order = suffix_dedup.Sorter(text, 130).order(np.ones(len(text), dtype=bool))
    padded = [*text.tolist(), *[0] * 140]
    assert [padded[i : i + 130] for i in order] == sorted(padded[i : i + 130] for i in range(len(text)))


def test_chat_roles_are_recovered(spark):
    rows = queries.QUERIES["op8_chat_format"](spark, SF001).toPandas()
    talk = pd.read_parquet(f"{SF001}/conversations.parquet").sort_values(["conv_id", "turn"])
    truth = talk.groupby("conv_id")["role"].apply(",".join)
    got = rows.set_index("conv_id")["roles"]
    held = [i for i in truth.index if zlib.crc32(str(i).encode()) % 3 == 1]
    assert len(got) == len(truth) and (got[held] == truth[held]).mean() > 0.6
    assert all(r.count("<|im_start|>") == r.count("<|im_end|>") == n for r, n in zip(rows["rendered"], rows["n_turns"], strict=True))


def model():
    rng = np.random.default_rng(5)
    step = rng.random((chat_format.STATES + 1, chat_format.STATES))
    step[:, 1::2] *= np.array([[a // 2 == b // 2 and a < 6 for b in (1, 3, 5)] for a in range(7)])
    return chat_format.Model(step, [rng.random((chat_format.STATES, v)) + 0.1 for v in chat_format.VALUES])


def test_chunks_give_the_best_path_of_the_whole():
    m, rng = model(), np.random.default_rng(6)
    for n in (1, 2, 7, 40):
        obs = np.stack([rng.integers(0, v, n) for v in chat_format.VALUES], axis=1)
        scores = m.line_scores(obs)
        whole = m.transfer([scores])[0][chat_format.START].max()
        value = m.step[chat_format.START] + scores[0]
        for t in range(1, n):
            value = (value[:, None] + m.step[:6]).max(axis=0) + scores[t]
        assert whole == pytest.approx(value.max())
        last = int(m.transfer([scores])[0][chat_format.START].argmax())
        path = m.decode([scores], np.array([chat_format.START]), np.array([last]))[0]
        found = m.step[chat_format.START, path[0]] + sum(m.step[a, b] for a, b in zip(path[:-1], path[1:], strict=True))
        assert found + scores[np.arange(n), path].sum() == pytest.approx(value.max())


def test_chat_odd_rows(spark):
    parts = [
        (1, 0, "User: hello?\nmore"), (1, 1, "Assistant: hi."), (1, 1, "Assistant: hi."), (2, None, "### User\nq"), (None, 0, "Human: a"),
        (None, 0, "Human: a"), (3, 0, None), (4, 0, ""), (5, 700, "AI: late"), (5, 0, "Q: " + "long " * 5000),
    ]
    frame = spark.createDataFrame([(*p, "x") for p in parts], "conv_id long, part long, text string, block string")
    rows = chat_format.format_transcripts(frame, model()).collect()
    assert sorted(str(r["conv_id"]) for r in rows) == ["1", "2", "4", "5", "5", "None", "None"]
    whole = "\n".join(r["rendered"] for r in sorted((r for r in rows if r["conv_id"] == 5), key=lambda r: (r["block"], r["chunk"])))
    assert whole.startswith("<|im_start|>") and whole.endswith("<|im_end|>")
    assert chat_format.format_transcripts(frame.limit(0), model()).count() == 0


def test_a_long_conversation_is_decoded_in_chunks(spark):
    m = chat_format.learn_from_conversations(spark.read.parquet(f"{SF001}/conversations.parquet"))
    turns = [("Human: why?\nplease" if i % 2 == 0 else "AI: because.\nso it is") for i in range(1200)]
    frame = spark.createDataFrame([(9, i, t) for i, t in enumerate(turns)], "conv_id long, part long, text string")
    rows = sorted(chat_format.format_transcripts(frame, m).collect(), key=lambda r: (r["block"], r["chunk"]))
    assert len(rows) == 5
    assert ",".join(r["roles"] for r in rows) == ",".join(["user", "assistant"] * 600)
    assert sum(r["rendered"].count("<|im_end|>") for r in rows) == 1200


assert DOCS
