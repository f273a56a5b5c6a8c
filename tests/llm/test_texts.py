"""Operators over texts: token counts, packing, overlaps, prose labels, leaks, garbled text."""

import pickle
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexcurate.llm import bpe, budget, fulltext, garbled, leaks, overlaps, packing, quality

FEW = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
VOCABULARIES = ["/opt/tokenizers/byte_bpe_50k.tiktoken", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"]
needs_vocabulary = pytest.mark.skipif(not Path(bpe.VOCABULARY).exists(), reason="no vocabulary here")


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module", params=VOCABULARIES)
def pair(request):
    import tiktoken

    if not Path(request.param).exists():
        pytest.skip("no vocabulary here")
    counter = bpe.Counter(Path(request.param).read_bytes())
    return counter, tiktoken.Encoding("own", pat_str=bpe.PIECES, mergeable_ranks=counter.rank, special_tokens={})


@settings(max_examples=300, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60) | st.text("abcdeths 's.\n\t0²½İßЖ中\x1c ", max_size=80))
def test_counts_like_an_encoder(pair, text):
    counter, encoding = pair
    assert counter.count(text) == len(encoding.encode_ordinary(text))


def test_long_pieces_take_linear_time(pair):
    counter, encoding = pair
    assert counter.count("ab" * 50_000) == counter.encoded("ab" * 50_000) > 0
    text = "".join(random.Random(1).choices("etaoinshrdlu", k=20_000))
    assert counter.count(text) == len(encoding.encode_ordinary(text))
    assert counter.count("") == 0


@needs_vocabulary
def test_budget(spark):
    rows = [("Pub ", "en-GB", "http://a.x/", "the court", 5), ("pub", "EN", "http://www.a.x", "the court", None), (None, None, None, None, 7), ("", "und", "", "", 0), ("pub", "fr", "http://b.x", "l’été", 1)]
    df = spark.createDataFrame(rows, "source string, lang string, url string, text string, n_chars long").withColumn("tokens", F.lit(9))
    got = {(r["source"], r["lang"], r["site"], r["level"]): (r["documents"], r["tokens"]) for r in budget.token_budget(df).collect()}
    n = {r["text"]: r["n_tokens"] for r in budget.counted(df).collect()}
    assert n[None] == n[""] == 0 and n["the court"] == 2
    assert got[("pub", "en", "a.x", 0)] == (2, 4) and got[("unknown", "unknown", "unknown", 0)] == (2, 0)
    assert got[(None, None, None, 7)] == (5, 4 + n["l’été"]) and got[("pub", None, None, 3)] == (3, 4 + n["l’été"])
    assert budget.token_budget(df.limit(0)).count() == 0


# ---------------------------------------------------------------- packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=12))
def test_fillings_use_everything_once(counts):
    plan = packing.fillings(counts, 40)
    used = Counter()
    for f in plan:
        assert sum(n * k for n, k in f.lengths) <= 40 and f.times > 0
        for n, k in f.lengths:
            used[n] += k * f.times
    assert used == Counter({n: c for n, c in counts.items() if c})
    assert len(plan) <= 40 * 6


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 3), min_size=1, max_size=6), st.integers(0, 60))
def test_closest_sum_like_brute_force(counts, room):
    sums = {0}
    for n, c in counts.items():
        sums = {s + n * k for s in sums for k in range(c + 1)}
    used = packing._closest(counts, room)
    assert sum(n * k for n, k in used.items()) == max(s for s in sums if s <= room) and all(k <= counts[n] for n, k in used.items())


def test_packed(spark):
    rng = random.Random(2)
    sizes = [rng.choice([0, None, 7, 7, 7, 100, 2048, 2049, 5000, rng.randint(1, 2048)]) for _ in range(600)]
    df = spark.createDataFrame([(k // 2, n) for k, n in enumerate(sizes)], "doc_id long, n_tokens long").withColumn("piece", F.lit("x")).withColumn("rank", F.lit(1))
    got = packing.packed(df).collect()
    per, slots = defaultdict(int), defaultdict(set)
    for r in got:
        if r["container"] is None:
            assert not r["n_tokens"]
            continue
        size = r["token_to"] - r["token_from"]
        assert 0 < size <= 2048 and (r["n_tokens"] > 2048 or size == r["n_tokens"])
        per[r["container"]] += size
        assert r["position"] not in slots[r["container"]]
        slots[r["container"]].add(r["position"])
    total = sum(n or 0 for n in sizes)
    assert sum(per.values()) == total and max(per.values()) <= 2048 and sorted(per) == list(range(len(per)))
    assert all(s == set(range(1, len(s) + 1)) for s in slots.values())
    assert len(per) <= total / 2048 * 1.02 + 1
    assert sum(r["container"] is None for r in got) == sum(not n for n in sizes)
    assert packing.packed(df.limit(0)).count() == 0


# ---------------------------------------------------------------- overlaps


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    return row[-1]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=30), st.lists(st.integers(0, 4), max_size=30))
def test_common_words(a, b):
    assert overlaps.common_words(a, b) == lcs(a, b)


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 1 << 24), max_size=200, unique=True), st.lists(st.integers(0, 1 << 25), max_size=50))
def test_increasing(values, asked):
    values = np.array(sorted(values), "int64")
    sequence = fulltext.Increasing(values)
    assert sequence[np.arange(len(values))].tolist() == values.tolist()
    asked = np.array([*asked, *values.tolist()], "int64")
    assert sequence.below(asked).tolist() == np.searchsorted(values, asked).tolist()


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.sampled_from("abc"), min_size=1, max_size=12), min_size=1, max_size=5), st.lists(st.sampled_from("abcd"), min_size=1, max_size=8))
def test_backward_search(texts, asked):
    index = pickle.loads(pickle.dumps(fulltext.TextIndex(texts)))
    codes = np.array([index.ids.get(w, -1) for w in asked])
    low, high = index.pairs_of_words(codes, np.arange(len(asked)))
    for end in range(len(asked)):
        found = Counter(k for k, t in enumerate(texts) for i in range(len(t) - 1) if t[i : i + 2] == asked[end - 1 : end + 1])
        assert Counter(int(index.keys[k]) for k in index.text[low[end] : high[end]]) == found
    names = {k: w for w, k in index.ids.items()}
    _, words = index.read(np.arange(len(texts)))
    assert [names[w] for w in words] == [w for k in index.keys for w in texts[int(k)]]


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        if kind == 0:
            words[at] = f"new{rng.randrange(50)}"
        elif kind == 1:
            del words[at]
        else:
            words.insert(at, f"new{rng.randrange(50)}")
    return words


def test_overlaps_like_brute_force(spark):
    rng = random.Random(3)
    texts = [[rng.choice("the of court law a b c d e f g h".split()) if rng.random() < 0.5 else f"w{rng.randrange(400)}" for _ in range(rng.randint(15, 60))] for _ in range(40)]
    rows, members = [], []
    for k, t in enumerate(texts * 3):
        words = edited(rng, t, rng.choice([0, 0, 2, 4, 6, 8, 12])) if k >= 40 else t
        text = rng.choice([" ", ", ", "\n"]).join(w.upper() if rng.random() < 0.2 else w for w in words)
        rows.append((f"i{k:03}", text, k % 6))
        members.append((f"i{k:03}", rng.choice(["train", "train", "validation", "test", None])))
    rows += [rows[0], ("i001", None, 1), (None, rows[1][1], 2), ("none", rows[2][1], 2), ("i900", "", 1)]
    members.append(("i900", "test"))
    df = spark.createDataFrame([(i, t, s, f"http://s{i and i[-1]}/", "x") for i, t, s in rows], "id string, text string, score int, url string, words string")
    split = spark.createDataFrame(members, "id string, split string").withColumn("text", F.lit("x"))
    of = {i: s for i, s in members if s}
    worded = {i: re.findall(r"[^\W_]+", t.lower()) for i, t, _ in rows if i in of and t}
    want = set()
    for a in worded:
        for b in worded:
            if of[a] == "train" != of[b] and min(len(worded[a]), len(worded[b])) >= 20 and lcs(worded[a], worded[b]) >= 0.85 * max(len(worded[a]), len(worded[b])):
                want.add((min(a, b), max(a, b)))
    assert len(want) > 10
    for options in ({}, {"shard_words": 100, "block_bytes": 10_000}, {"seeds": 1}):
        got = overlaps.overlapping_ids(df, split, **options).collect()
        assert {(r["id_a"], r["id_b"]) for r in got} == want and len(got) == len(want)
    report = overlaps.overlap_report(df, split).collect()
    assert sum(r["pairs"] for r in report) == len(want) and all(0 <= r["share"] <= 1 and r["split"] != "train" for r in report)
    score = {i: max((s for j, _, s in rows if j == i and 0 <= s <= 5), default=None) for i, _, _ in rows}
    assert sum(r["disagreeing"] for r in report) == sum(score[a] != score[b] for a, b in want)
    assert sum(r["overlapping"] for r in report) == len({i for pair in want for i in pair if of[i] != "train"})
    both = split.union(spark.createDataFrame([("i000", "train", "x"), ("i000", "test", "x")], split.schema))
    pairs = overlaps.overlapping_ids(df, both).select("eval_id", "train_id").distinct().count()
    assert sum(r["pairs"] for r in overlaps.overlap_report(df, both).collect() if r["split"] == "test") <= pairs
    assert overlaps.overlapping_ids(df.limit(0), split).count() == 0 and overlaps.overlapping_ids(df, split.limit(0)).count() == 0


def test_spans_hold_whole_matches():
    text = [f"w{k}" for k in range(10)] + ["the"] * 2 + ["court"] * 10
    index = fulltext.TextIndex([text], ["k"])
    assert overlaps.matched(index, ["a"], [text]) == [("a", "k", 22, 22, 1, 22)]
    assert overlaps.matched(index, ["a"], [[*text[:5], "new", *text[6:]]]) == [("a", "k", 21, 22, 2, 21)]
    assert overlaps.matched(index, ["a"], [text[:2]]) == [] and overlaps.matched(index, [], []) == []


def test_texts_too_short_for_the_share():
    index = fulltext.TextIndex([["a", "b", "c", "d"]], ["k"])
    with pytest.raises(ValueError, match="share"):
        overlaps.matched(index, ["a"], [["a", "x", "c", "d"]], share=0.5)


# ---------------------------------------------------------------- prose labels

PROSE = [
    "The court found that the claim of the plaintiff was not supported by the record. It is ordered that the appeal be dismissed, and that each party pay its own costs in this matter.",
    "El tribunal declaró que la demanda no estaba fundada en el contrato, por lo que se rechaza el recurso y se condena en costas a la parte que lo interpuso sin razón.",
    "Le tribunal a relevé que la requête n'était pas fondée, et que le bailleur avait agi sans la clause exigée par la loi dans cette affaire.",
    "Das Gericht führte aus, dass der Kläger ohne die Zustimmung der Beklagten gehandelt habe und dass die Frist für den Einspruch nicht eingehalten worden sei.",
    "O tribunal decidiu que a cláusula não era válida e que o inquilino devia pagar as custas do processo, como já tinha sido dito na sentença.",
]
OTHER = [
    "\n".join(f"- Deed {n} Marlow / Pike Holdings" for n in range(12)),
    "\n".join(f"Marlow Pike;{n * 37};20{n:02}-01-02;{n}.50;PX-{n}" for n in range(12)),
    "\n".join(f"| Pike | {n} | {n * 7} | open |" for n in range(12)),
    "permit freight custody survey deposition royalty trespass ledger bond patent salvage milling drainage " * 4,
    "=-=-=-=-=-=-=-=-=-=\n#_#_#_#_#_#_#_#_#\n********************* 123\n-.-.-.-.-.-.-.-.-.-.-.-",
]
TABLE = "doc_id long, text string, url string"


def test_prose_and_other_texts(spark):
    texts = PROSE + [t.upper() for t in PROSE] + [re.sub(r"(\S+ \S+ \S+) ", r"\1\n", t) for t in PROSE] + [t.replace(" ", "\n") for t in PROSE] + OTHER
    df = spark.createDataFrame([(k, t, None) for k, t in enumerate(texts)] + [(90, None, None), (91, "", None), (92, "- a\n- b", None), (None, OTHER[0], None)], TABLE).withColumn("prose", F.lit(1))
    stats = quality.text_statistics(df, quality.initial())
    assert sorted(r["doc_id"] for r in quality.not_prose(stats).select("doc_id").fillna(-1).collect()) == [-1, *range(len(texts) - len(OTHER), len(texts))]
    rows = {r["doc_id"]: r for r in stats.collect()}
    assert rows[90]["chars"] == rows[91]["words"] == 0 and rows[0]["ended_lines"] == 1 and rows[0]["mean_word_length"] > 3
    assert rows[len(texts) - 4]["table"] > 0.9 and rows[len(texts) - 5]["list"] > 0.9 and rows[len(texts) - 1]["junk"] + rows[len(texts) - 1]["table"] > 0.9
    assert quality.text_statistics(df.limit(0)).count() == 0


def test_fit_keeps_the_labels(spark):
    df = spark.createDataFrame([(k, (PROSE + OTHER)[k % 10], None) for k in range(300)], TABLE)
    model = quality.fit_on(quality.line_table(df))
    assert np.allclose(model.moves.sum(axis=1), 1) and model.start.sum() == pytest.approx(1) and model.moves[1, 1] > 0.9
    assert model.common[0] > 0.2 > 0.1 > max(model.common[1:])
    assert quality.not_prose(quality.text_statistics(df, model)).count() == 150


def test_fit_is_on_all_documents(spark):
    texts = [(PROSE + OTHER)[k % 10] for k in range(2300)]
    df = spark.createDataFrame([(k // 2, t, None) for k, t in enumerate(texts)], TABLE)
    got, want = quality.fit_on(quality.line_table(df)), quality.fit(texts)
    assert all(np.array_equal(a, b) for a, b in zip((got.common, got.start, got.moves, *got.tables), (want.common, want.start, want.moves, *want.tables)))


def test_common_words_of_narrative_prose():
    for words in ["he she they will been there any its", "sus ya este cuando", "ce elle son cette", "einem einen werden war", "nas nos mas é"]:
        assert quality.line_features(words)[1] == len(words.split())


def test_repeated_lines_do_not_count(spark):
    notice = "The text above is not legal advice and we accept no liability for any of the errors that are in it."
    rows = [(k, notice + f"\n- Deed {k} Marlow / Pike Holdings\n- Bond {k} Pike / Marlow", "http://a.x/") for k in range(6)]
    df = spark.createDataFrame(rows, TABLE)
    assert quality.not_prose(quality.text_statistics(df, quality.initial())).count() == 6
    assert quality.not_prose(quality.text_statistics(df, quality.initial(), without_repeated=False)).count() == 0


def test_decoding_is_the_best_path():
    rng = np.random.default_rng(4)
    model = quality.fit(PROSE + OTHER)
    x, lengths = quality._lines(["\n".join(rng.choice(["the court of law", "- Pike 12", "a;b;c", "", "=-=-"], n)) for n in (1, 3, 5, 0, 4)])
    got = quality.decode(x, lengths, model)
    move = np.log(model.moves)
    e, at = model.emissions(x), 0
    for n in lengths:
        score = lambda p: np.log(model.start[p[0]]) + sum(e[at + t, s] for t, s in enumerate(p)) + sum(move[a, b] for a, b in zip(p, p[1:]))  # noqa: E731, B023
        if n:
            best = max(np.ndindex(*[4] * n), key=score)
            assert score(tuple(got[at : at + n])) == pytest.approx(score(best))
        at += n


# ---------------------------------------------------------------- leaks


def passage(rng, n):
    return [rng.choice(["the", "court", "of", "law", "rule", "under", "pay", f"{rng.randrange(90)}", "Pike", "Marlow", "days"]) + ("" if rng.random() < 0.6 else str(rng.randrange(30))) for _ in range(n)]


def test_leaks_like_brute_force(spark):
    rng = random.Random(5)
    items = [passage(rng, rng.randint(10, 45)) for _ in range(20)]
    docs = []
    for k in range(60):
        words = passage(rng, rng.randint(0, 50))
        if k % 2:
            item = rng.choice(items)
            a = rng.randrange(len(item))
            words += item[a : a + rng.choice([18, 19, 20, 21, 40])] + passage(rng, 5)
        docs.append((k, rng.choice([" ", ", ", "\n"]).join(rng.choice([str, str.upper, str.lower])(" ".join(words)).split(" "))))
    docs += [(100, None), (101, ""), docs[1], (None, " ".join(items[0]))]
    windows = lambda ws: {tuple(w.lower() for w in ws[i : i + 20]) for i in range(len(ws) - 19)}
    want = {(d, i) for d, t in docs if t and d is not None for i, item in enumerate(items) if windows(re.findall(r"[^\W_]+", t)) & windows(item)}
    assert len(want) > 5
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item_id", F.lit(1))
    asked = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)] + [(50, None), (51, "")], "item_id long, text string")
    got = leaks.leaked_items(df, asked).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)
    assert leaks.leaked_items(df.limit(0), asked).count() == 0 and leaks.leaked_items(df, asked.limit(0)).count() == 0


def test_bit_tables():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 50_000).astype("uint64") * np.uint64(2)
    table = leaks.Bits(leaks.Bits.fitting(len(hashes)))
    table.add(hashes)
    assert len(table.has(hashes)) == len(hashes) and len(table.has(hashes + np.uint64(1))) < 50
    assert leaks.Bits.fitting(0) == leaks.LEAST_BITS and leaks.Bits.fitting(1 << 40) == leaks.MOST_BITS


def test_full_bit_tables_change_nothing(spark, monkeypatch):
    rng = random.Random(8)
    docs = [(k, " ".join(f"w{rng.randrange(300)}x" for _ in range(60))) for k in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    asked = spark.createDataFrame([(k, t) for k, t in docs[:50]] + [(100 + k, " ".join(f"v{rng.randrange(300)}y" for _ in range(60))) for k in range(50)], "item_id long, text string")
    monkeypatch.setattr(leaks.Bits, "fitting", staticmethod(lambda entries: leaks.PIECE * 8))
    assert {(r[0], r[1]) for r in leaks.leaked_items(df, asked).collect()} == {(k, k) for k in range(50)}


def test_other_parameters(spark):
    item = "If Pike pays 12 pounds to the owner of the mill before the end of March then Pike may keep the mill for 12 years without any further rent"
    good = "Asked: " + item.replace("Pike", "Marlow").replace("12", "15") + " or not"
    mixed = item.replace("Pike", "Marlow", 1)
    df = spark.createDataFrame([(1, good), (2, mixed), (3, item), (4, None)], "doc_id long, text string")
    asked = spark.createDataFrame([(7, item)], "item_id long, text string")
    got = {r["doc_id"]: r["windows"] for r in leaks.reparameterised_items(df, asked, window=15, min_literals=8).collect()}
    assert 1 in got and got[1] > got.get(2, 0) and 3 not in got
    assert {r["doc_id"] for r in leaks.leaked_items(df, asked).collect()} == {2, 3}


# ---------------------------------------------------------------- garbled text

CLEAN = [
    "Le bailleur n’a pas été présent à l’audience – il a versé 12 € au notaire, à Évreux.", "Die Übergangsordnung verpflichtet jeden Gläubiger; außerdem rügte er die „förmliche“ Zustellung.",
    "La resolución declaró válida la cláusula § 12 … “íntegra”.", "A SEÇÃO NÃO É VÁLIDA PARA O CIDADÃO; 3.º ARTIGO, n.º 5.", "Under 42 U.S.C. § 1983 — see §§ 20–30; © 2019 Pike. It costs £12.", "plain ascii text only", "",
    "SÃO PAULO\xa0É GRANDE, AMANHÃ\xa0TAMBÉM", "Москва и Гётеборг — города", "1 m³ of water at 20 °C, ½ of it", "¿Qué? ¡Sí! 3 × 4 ÷ 2 = 6 ± 1",
]


def test_clean_texts_stay(spark):
    for text in CLEAN:
        assert not garbled.is_garbled(text) and garbled.restored(text) == text
    df = spark.createDataFrame([(k, t) for k, t in enumerate(CLEAN)] + [(99, None)], "doc_id long, text string")
    assert garbled.garbled_documents(df).count() == 0 and garbled.garbled_documents(df.limit(0)).count() == 0


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "mac_roman", "cp1251", "cp437", "cp850", "iso8859-15", "cp1250", "koi8-r"])
def test_round_trip(encoding):
    for text in CLEAN[:5]:
        broken = "".join(garbled._byte(b, encoding) for b in text.encode("utf-8"))
        assert garbled.is_garbled(broken) and garbled.restored(broken) == text
        # the rest of a text is left as it is
        mixed = text + "\n" + broken + "\n" + CLEAN[2]
        assert garbled.restored(mixed) == text + "\n" + text + "\n" + CLEAN[2]


FOREIGN = [
    "Wyrok sądu został ogłoszony w piątek; świadek nie przyszedł, więc żądano zwłoki.", "Soud rozhodl, že žaloba není důvodná, a řízení zastavil.", "Instanța a respins cererea și a dispus executarea hotărârii.",
    "Решение суда вступило в силу. Истец и ответчик согласны с ним.", "Το δικαστήριο έκρινε ότι η αγωγή δεν είναι βάσιμη και την απέρριψε.", "法院认为原告的请求没有依据，驳回上诉。", "裁判所は原告の請求を棄却した。",
]


@pytest.mark.parametrize("encoding", garbled.WIDE)
def test_other_scripts_come_back(encoding):
    for text in FOREIGN:
        assert not garbled.is_garbled(text) and garbled.restored(text) == text
        seen = "".join(garbled._byte(b, encoding) if b >= 0x80 else chr(b) for b in text.encode())
        assert garbled.is_garbled(seen) and garbled.restored(seen) == text
        mixed = "Left as it is: naïve “façade” é\xa0» MENÜ“ LIBERTÉ»\n" + seen
        assert garbled.restored(mixed) == "Left as it is: naïve “façade” é\xa0» MENÜ“ LIBERTÉ»\n" + text


def test_many_layers_are_undone():
    text = seen = "El plazo venció según la cláusula."
    for _ in range(10):
        seen = seen.encode().decode("latin-1")
    assert garbled.restored(seen) == text


def test_garbled_twice():
    once = lambda t: "".join(garbled._byte(b, "cp1252") for b in t.encode("utf-8"))
    for text in CLEAN[:5]:
        assert garbled.restored(once(once(text))) == text


@pytest.mark.parametrize("encoding", ["cp850", "cp437"])
def test_single_bytes(encoding):
    for text in CLEAN[:3]:
        broken = text.encode("cp1252").decode(encoding)
        assert garbled.is_garbled(broken)
        fixed = garbled.restored(broken)
        assert sum(a == b for a, b in zip(fixed, text)) >= 0.97 * len(text)


@pytest.mark.parametrize("encoding", ["cp850", "cp437", "mac_roman"])
def test_lone_hard_spaces_and_ellipses(encoding):
    texts = ["By\xa0Tremo\xa0Wexaenoth,\xa0Dralogardlaw law desk", "REPORT\xa0OF THE COURT", "Read\xa021\xa0more\xa0documents", "the\xa0text\xa0above\xa0is", "Was this useful to you? No (8) …", "Read more of our rulings …\nSee Pike v. Pike", "Il a été jugé …", "the rule [...] of law […] stands"]
    for text in texts[:6] + texts[7:]:
        broken = text.encode("cp1252").decode(encoding)
        assert garbled.is_garbled(broken) and garbled.restored(broken) == text
    assert garbled.is_garbled("Lire la suite à") and garbled.is_garbled("Ler mais à\n\nO juiz")
    for text in ["la situation était déjà connue et il condamne le bailleur à\nverser 12 euros", "o juiz da comarca condena o réu à\npena", "Sánchez está en la página 12", "Bogotá, Panamá; será así", "In the matter of Hernández and Málaga", "Está1 en el artículo", "L’Haÿ-les-Roses", "voilà, déjà"]:
        assert not garbled.is_garbled(text)


def test_letters_that_no_language_here_has():
    for text in ["los años de la señora", "Le père de la requérante doit être entendu", "O juiz não viu as razões da parte", "dans la cour, à la fin"]:
        broken = text.encode("cp1252").decode("cp1250")
        assert garbled.is_garbled(broken) and garbled.restored(broken) == text
    assert garbled.is_garbled("Das Gericht hat für die Klägerin und den Hörer entschieden".encode("mac_roman").decode("cp1252", "replace").replace("�", ""))
    for text in ["In the matter of Dubček, Wałęsa and Kovač, for the court", "l’arrêt de la cour dans Gdańsk c. Poznański", "la causa de Kovačević y los demás"]:
        assert not garbled.is_garbled(text)


@pytest.mark.parametrize("encoding", ["cp1252", "latin-1", "mac_roman", "cp1250", "cp437", "cp850"])
def test_signs_beyond_latin_1(encoding):
    for c in "\ufeff\u202f\u2011\u2212\u2010→✓ﬁ🙂":
        broken = "".join(garbled._byte(b, encoding) for b in f"the{c}law".encode())
        assert garbled.is_garbled(broken) and garbled.restored(broken) == f"the{c}law"


def test_lost_characters(spark):
    df = spark.createDataFrame([(1, "versp�tet", 5), (2, "Ã©tÃ©", 6), (3, "ok", 7), (2, "Ã©tÃ©", 6)], "doc_id long, text string, restored int")
    got = {r["doc_id"]: (r["restored"], r["complete"]) for r in garbled.restored_documents(df).collect()}
    assert got == {1: ("versp�tet", False), 2: ("été", True)}


def test_long_texts():
    text = ("x" * 1000 + " été " + "Ã©") * 200
    assert garbled.restored(text) == ("x" * 1000 + " été é") * 200
