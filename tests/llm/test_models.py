"""Toxicity, quality and language on held-out documents and awkward rows; fingerprints by their algebra."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from requestlens.llm import fingerprints, languages, quality, toxicity
from requestlens.llm.sampling import labelled_texts
from requestlens.llm.words import mix, pieces
from tests.llm.rows import LONG, TEXTS, awkward, documents, labels, nothing

FOLDER = "/root/testdata/sf0.1"


def given(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


def area(scores, truth):
    order = np.argsort(scores, kind="stable")
    rank = np.empty(len(scores))
    rank[order] = np.arange(1, len(scores) + 1)
    n = truth.sum()
    return (rank[truth == 1].sum() - n * (n + 1) / 2) / (n * (len(truth) - n))


@pytest.mark.parametrize(("score", "label", "divisor", "remainder"), [(toxicity.score_toxicity, "toxic", 5, 0), (quality.score_quality, "quality", 3, 1)])
def test_held_out_labels(spark, score, label, divisor, remainder):
    truth = given(spark, "labels")
    got = score(given(spark, "documents"), truth).join(truth, "doc_id").select("doc_id", "held_out", "score", "predicted", label).toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % divisor == remainder for i in got.doc_id]).all()
    held = got[got.held_out]
    assert held.score.between(0, 1).all() and ((held.score >= 0.5) == held.predicted).all()
    assert area(held.score.to_numpy(), held[label].to_numpy()) > 0.97


@pytest.mark.parametrize(("score", "label"), [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_scores_of_awkward_rows(spark, score, label):
    rows = [(i, i % 2, i % 2, "x") for i in (1, 2, 6, 7, 8, 10, 12, 13)] + [(None, 1, 1, None), (9, None, None, None), (2, 0, 0, "again"), (99, 1, 1, "")]
    got = score(awkward(spark), labels(spark, rows)).collect()
    assert len(got) == len(TEXTS) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 10}) == 1
    assert {r.score for r in got if r.doc_id in (3, 4)} == {next(r.score for r in got if r.doc_id == 5)}
    assert score(nothing(spark), labels(spark, rows)).collect() == []
    assert {r.score for r in score(awkward(spark), labels(spark, [])).collect()} == {0.5}


def test_pairs_of_terms_matter_only_together(spark):
    """Each word alone is harmless; the two together are not."""
    rng = random.Random(3)
    filler = [f"w{i}" for i in range(40)]
    rows, marks = [], []
    for i in range(3000):
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        text = rng.sample(filler, 6) + ["insultium"] * insult + ["groupish"] * group
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, 0, int(insult and group), ""))
    got = toxicity.score_toxicity(documents(spark, rows), labels(spark, marks)).where("held_out").collect()
    truth = np.array([marks[r.doc_id][2] for r in got])
    assert ((np.array([r.score for r in got]) >= 0.5) == truth).mean() > 0.97


def test_pairs_without_a_difference_term_by_term(spark):
    """Among thousands of terms, two whose shares are equal in both classes: one of them alone is toxic, both or none are not."""
    rng = random.Random(3)
    filler = [f"{rng.randrange(16**6):06x}" for _ in range(5000)]
    rows, marks = [], []
    for i in range(4000):
        one, other = rng.random() < 0.5, rng.random() < 0.5
        text = rng.sample(filler, 12) + ["insultium"] * one + ["groupish"] * other
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        marks.append((i, 0, int(one != other), ""))
    got = toxicity.score_toxicity(documents(spark, rows), labels(spark, marks)).where("held_out").collect()
    truth = np.array([marks[r.doc_id][2] for r in got])
    assert ((np.array([r.score for r in got]) >= 0.5) == truth).mean() > 0.97


def test_every_slot_of_the_sample_is_in_use():
    texts = [f"common{i % 3} rare{i} " + ("insult" if i % 2 else "praise") for i in range(3000)]
    chunks = [(slots, bounds) for _, slots, bounds in toxicity.terms(pa.array(texts))]
    machine = toxicity.fit(chunks, np.arange(3000) % 2, epochs=1)
    slots = np.unique(np.concatenate([s for s, _ in chunks]))
    assert len(slots) > 2048 and (machine.place[slots] >= 0).all() and len(machine.weights) == len(slots)


def test_attention_finds_one_bad_passage(spark):
    clean, bad = "Some plain words follow each other here. " * 60, "BUY!! $$$ NOW!! ### " * 16
    rows = [(i, clean[: 400 + 37 * (i % 40)] + (bad if i % 2 else "") + clean[: 300 + 53 * (i % 30)]) for i in range(300)]
    got = quality.score_quality(documents(spark, rows), labels(spark, [(i, 1 - i % 2, 0, "") for i, _ in rows])).where("held_out").collect()
    assert all(r.predicted == 1 - r.doc_id % 2 for r in got)


def test_quality_learns_wording(spark):
    """Texts of one typography: only the choice of a few words among thousands tells the classes apart."""
    rng = random.Random(5)
    marks, rows = [], []
    for i in range(1500):
        y = rng.random() < 0.5
        telling = [f"{'sound' if y else 'dross'}{k}" for k in range(150)]
        rows.append((i, " ".join(rng.choice(telling) if rng.random() < 0.05 else f"words{rng.randrange(3000)}" for _ in range(rng.randint(60, 400)))))
        marks.append((i, int(y), 0, ""))
    got = quality.score_quality(documents(spark, rows), labels(spark, marks)).where("held_out").collect()
    assert area(np.array([r.score for r in got]), np.array([marks[r.doc_id][1] for r in got])) > 0.95


@pytest.mark.parametrize(("score", "label"), [(toxicity.score_toxicity, "toxic"), (quality.score_quality, "quality")])
def test_classes_of_long_texts_are_learned(spark, score, label):
    """One class has only texts above the bytes that are learned from of one text."""
    long = "vile insultium !! " * 8000
    rows = [(i, f"{long} {i}" if i % 2 else f"plain words {i} " * 20) for i in range(60)]
    got = score(documents(spark, rows), labels(spark, [(i, i % 2, i % 2, "") for i, _ in rows])).where("held_out").collect()
    assert {r.doc_id % 2 for r in got} == {0, 1} and all(r.predicted == r.doc_id % 2 for r in got)


def test_sample_keeps_to_its_bytes(spark):
    rows = [(i, f"{i:04d} " * 200) for i in range(100)]
    marks = labels(spark, [(i, i % 2, 0, "") for i, _ in rows])
    drawn = lambda most, total: labelled_texts(documents(spark, rows), marks, "quality", F.lit(True), 50, most, 1, total).collect()
    assert len(drawn(5000, 1 << 30)) == 50 and len(drawn(5000, 9500)) == 10
    assert all(len(r["_text"]) <= 100 for r in drawn(100, 1 << 30))


def test_machine_against_all_pairs():
    rng = np.random.default_rng(2)
    place = np.full(1 << toxicity.SLOT_BITS, -1, dtype=np.int32)
    place[:30] = rng.permutation(30)
    machine = toxicity.Machine(-0.3, place, rng.normal(0, 0.5, 30), rng.normal(0, 0.3, (30, toxicity.FACTORS)))
    texts = [sorted(rng.choice(40, rng.integers(0, 12), replace=False).tolist()) for _ in range(50)]
    got = machine.score(np.array([x for t in texts for x in t], dtype=np.int32), np.cumsum([0] + [len(t) for t in texts]))
    for text, score in zip(texts, got, strict=True):
        known = [place[x] for x in text if place[x] >= 0]
        raw = machine.bias + sum(machine.weights[i] for i in known)
        raw += sum(machine.factors[i] @ machine.factors[j] for n, i in enumerate(known) for j in known[:n])
        assert score == pytest.approx(1 / (1 + np.exp(-raw)))


def small_net():
    rng = np.random.default_rng(3)
    h, w = quality.HIDDEN, quality.FEATURES + quality.EMBEDDED
    shapes = {"e": (1 << quality.SLOT_BITS, quality.EMBEDDED), "a": (w, h), "b": (h,), "v": (h, h), "u": (h, h), "w": (h,), "c": (h,), "d": (1,)}
    net = quality.Bags(rng.normal(0, 0.1, quality.FEATURES), rng.uniform(0.5, 2, quality.FEATURES), {k: rng.normal(0, 0.3, s) for k, s in shapes.items()})
    size = np.array([3, 0, 64, 5, 1, 64, 64, 9])
    bags = quality.Passages(rng.normal(0, 1, (8, quality.FEATURES)), np.array([0, 1, 2, 4, 8]), rng.integers(0, 1 << quality.SLOT_BITS, size.sum()).astype(np.int32), size)
    return net, bags


def test_attention_against_plain_loops():
    net, bags = small_net()
    p, words = net.parts, np.split(bags.slots, np.cumsum(bags.size)[:-1])
    for text, score in enumerate(net.score(bags)):
        encoded, raw = [], []
        for i in range(bags.first[text], bags.first[text + 1]):
            embedded = sum((p["e"][s] for s in words[i]), np.zeros(quality.EMBEDDED)) / max(1, len(words[i])) ** 0.5
            h = np.tanh(np.concatenate([(bags.features[i] - net.mean) / net.spread, embedded]) @ p["a"] + p["b"])
            encoded.append(h)
            raw.append(sum(p["w"][k] * np.tanh(h @ p["v"][:, k]) / (1 + np.exp(-(h @ p["u"][:, k]))) for k in range(quality.HIDDEN)))
        weights = np.exp(raw) / np.exp(raw).sum()
        z = sum(w * h for w, h in zip(weights, encoded, strict=True))
        assert score == pytest.approx(1 / (1 + np.exp(-(z @ p["c"] + p["d"][0]))))


def test_slopes_against_differences():
    net, bags = small_net()
    truth = np.array([1, 0, 0, 1])
    loss = lambda: -np.log(np.where(truth == 1, net.score(bags), 1 - net.score(bags))).sum()
    slopes = net.slopes(bags, net.score(bags) - truth)
    rng = np.random.default_rng(4)
    for name, part in net.parts.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in part.shape) if name != "e" else (rng.choice(bags.slots), rng.integers(0, quality.EMBEDDED))
            kept = part[at]
            part[at] = kept + 1e-5
            up = loss()
            part[at] = kept - 1e-5
            down = loss()
            part[at] = kept
            assert slopes[name][at] == pytest.approx((up - down) / 2e-5, rel=1e-4, abs=1e-8)


def test_languages_held_out(spark):
    docs = given(spark, "documents")
    got = languages.identify_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() > 0.98
    assert got.score.between(0, 1).all()


def test_languages_of_awkward_rows(spark):
    got = languages.identify_languages(awkward(spark)).collect()
    assert len(got) == len(TEXTS)
    assert all((r.lang_pred == "und") == (r.doc_id in (3, 4, 5, 12) or r.score == 0) for r in got)
    assert {r.lang_pred for r in got} <= {"en", "de", "fr", "und"}
    assert languages.identify_languages(nothing(spark)).collect() == []
    unlabelled = documents(spark, [(1, "some words"), (2, None)]).selectExpr("*", "cast(null as string) AS lang")
    assert {r.lang_pred for r in languages.identify_languages(unlabelled).collect()} == {"und"}


def test_language_sample_stays_in_tasks(spark, monkeypatch):
    """A repeated row counts once, and the driver receives counts without texts."""
    rows = [(1, "der hund und das haus", "de")] * 50 + [(7, "the dog and the house", "en")]
    fetched = []
    frame = type(spark.range(0))
    to_arrow = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: fetched.append(self.columns) or to_arrow(self))
    model = languages.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4))
    once = languages.learn(["de", "en"], iter([(pa.array([rows[0][1], rows[-1][1]]), np.arange(2))]))
    assert np.allclose(model.scores, once.scores) and (model.scripts == once.scripts).all()
    assert all("text" not in columns for columns in fetched)


def test_every_language_is_learned(spark):
    """More than 200 languages, one with long texts only."""
    rows = [(i, " ".join(f"{c}{i % 230:03d}{c}" for c in "abcdefgh"), f"l{i % 230:03d}") for i in range(2300)]
    rows += [(i, " ".join(f"wort{j % 700}lang" for j in range(8_000)), "zz") for i in range(5000, 5004)]
    model = languages.fit_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3))
    assert model.languages == [f"l{k:03d}" for k in range(230)] + ["zz"]
    got = languages.label_texts(model, pa.array(["wort5lang wort6lang wort7lang"])).to_pylist()
    assert got[0]["lang_pred"] == "zz"


def test_passages_of_long_texts():
    text = " ".join(f"wörter{i}" for i in range(30_000))
    kept = languages.passages_of(text)
    assert 30_000 < len(kept.encode()) <= languages.SAMPLE_BYTES and set(kept.split()) <= set(text.split())
    assert languages.passages_of("short é") == "short é" and languages.passages_of(" " * 50_000) == ""
    assert languages.passages_of("語" * 50_000) == "語" * (languages.SAMPLE_BYTES // 3)


def small_model():
    texts = {"de": "der die das und nicht ein eine über schön haus zeit", "en": "the and not a house time over with nice this that", "ru": "дом время это что хорошо не"}
    codes = sorted(texts)
    column = pa.array([" ".join([texts[c]] * 5) for c in codes])
    return languages.learn(codes, iter([(column, np.arange(len(codes)))]))


def test_spans_of_mixed_text():
    model = small_model()
    text = "this house and that time with the nice house " * 2 + "das haus und die zeit nicht über eine schön zeit " * 2 + "это время что дом"
    got = languages.label_texts(model, pa.array([text, "дом", None, "12 -- 34", ""])).to_pylist()
    assert [s["lang"] for s in got[0]["spans"]] == ["en", "de", "ru"]
    assert got[0]["spans"][0] == {"lang": "en", "first_word": 0, "end_word": 18}
    assert got[1]["lang_pred"] == "ru" and [r["lang_pred"] for r in got[2:]] == ["und"] * 3


def letters_of(text):
    (_, words), = pieces(pa.array([text]))
    return int(languages.features(words, *languages.distinct_words(words)[:3])[3].sum())


def test_letters_by_code_point():
    marks = ["😀😀😀", "。。。", "×××"]
    assert [letters_of(t) for t in (*marks, "ދިވެހި", "ҳայոց", "ⵜⴰⵎⴰ", "a1é")] == [0, 0, 0, 3, 5, 4, 2]
    assert {r["lang_pred"] for r in languages.label_texts(small_model(), pa.array(marks)).to_pylist()} == {"und"}


def test_words_of_any_script_score():
    """Languages of scripts outside the common ranges, none of them the first by name."""
    texts = {"aa": "the house and time", "dv": "ދިވެހި ރާއްޖެ ބަހުން", "hy": "հայոց լեզու տուն", "nqo": "ߒߞߏ ߞߊ߲ ߛߓߍ", "syr": "ܠܫܢܐ ܣܘܪܝܝܐ", "th": "ภาษาไทย บ้าน", "zgh": "ⵜⴰⵎⴰⵣⵉⵖⵜ ⴰⵡⴰⵍ", "chr": "ᏣᎳᎩ ᎦᏬᏂᎯᏍᏗ"}
    codes = sorted(texts)
    model = languages.learn(codes, iter([(pa.array([texts[c] for c in codes]), np.arange(len(codes)))]))
    got = languages.label_texts(model, pa.array([texts[c].split()[0] for c in codes])).to_pylist()
    assert [r["lang_pred"] for r in got] == codes


def test_decoding_is_exact():
    """Against the plain recursion over all words."""
    rng = np.random.default_rng(5)
    for _ in range(60):
        lengths = rng.integers(0, 40, rng.integers(1, 9))
        first = np.concatenate([[0], np.cumsum(lengths)])
        emission = -rng.random((first[-1], 3)) * rng.choice([0.5, 4])
        path = languages.decode(emission, first, penalty=2.0)
        for a, b in zip(first[:-1], first[1:], strict=True):
            if a == b:
                continue
            e, p = emission[a:b], path[a:b]
            best = e.sum(0).argmax()
            value = np.where(np.arange(3) == best, 0.0, -2.0) + e[0]
            for row in e[1:]:
                value = np.maximum(value, value.max() - 2.0) + row
            own = e[np.arange(b - a), p].sum() - 2.0 * ((p[1:] != p[:-1]).sum() + (p[0] != best))
            assert own == pytest.approx(value.max())


def test_fingerprints_against_plain_edits(spark):
    rng = random.Random(4)
    rows = [(i * 3 - 20, " ".join(rng.choices(["ab", "é", "😀", "cd", "\n", "xyz"], k=rng.randint(0, 80)))) for i in range(200)] + [(5000, None), (None, "last é"), (6000, "")]
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    texts = [t or "" for _, t in ordered]
    edited = [fingerprints.edit(t, n) for t, n in zip(texts, texts[1:] + texts[:1], strict=True)]
    for size in (1 << 20, 600):
        got = {r.doc_id: r for r in fingerprints.fingerprint_documents(documents(spark, rows, 5), size).collect()}
        assert len(got) == len(rows)
        whole = [x.hex() for x in fingerprints.encoded(*fingerprints.fingerprints(pa.array(texts)))]
        changed = [x.hex() for x in fingerprints.encoded(*fingerprints.fingerprints(pa.array(edited)))]
        for (i, _), t, e, f, g in zip(ordered, texts, edited, whole, changed, strict=True):
            r = got[i]
            assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), f, g)
            assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_fingerprints_of_awkward_rows(spark):
    got = fingerprints.fingerprint_documents(awkward(spark), 2000).collect()
    assert sorted([r.doc_id for r in got], key=str) == sorted([i for i, _, _, _ in TEXTS], key=str)
    same = {}
    for r in got:
        same.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert same[1] == same[10] == same[11] and same[9] == same[14] and len(same[10]) == 1
    assert next(r.n_chars for r in got if r.doc_id == 9) == len(LONG)
    assert fingerprints.fingerprint_documents(nothing(spark)).collect() == []
    one = fingerprints.fingerprint_documents(documents(spark, [(1, "only one of these")])).collect()
    assert one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(fingerprints.edit("only one of these", "only one of these").encode()).hexdigest()


def plain_fingerprint(text):
    """Exact lanes and signed pairs of words of one text, by loops over its lines; its hashes of ranges come from the library."""
    exact, near = [0] * fingerprints.EXACT_LANES, [0] * fingerprints.NEAR_LANES
    for line in text.split("\n"):
        words = line.split()
        if not words:
            continue
        parts = [int(hashed_range(w)) for w in words]
        whole = hashed_range(line.strip())
        for k, key in enumerate(fingerprints._LANE_KEYS):
            exact[k] = (exact[k] + int(mix(np.array([whole ^ key]))[0])) % 2**64
        pairs = parts if len(parts) == 1 else [int(mix(np.array([(3 * a + b) % 2**64], np.uint64))[0]) for a, b in zip(parts, parts[1:])]
        for h in pairs:
            near[h % fingerprints.NEAR_LANES] += 1 if h >> 32 & 1 else -1
    return b"".join(v.to_bytes(8, "little") for v in exact) + b"".join((v % 2**16).to_bytes(2, "little") for v in near)


def hashed_range(text):
    (_, words), = pieces(pa.array([text]))
    return words.range_hashes([(words.start[:1], words.end[-1:])])[0][0]


def test_fingerprints_against_plain_sums():
    rng = random.Random(8)
    texts = ["\n".join(" ".join(rng.choices(["ab", "é", "😀", "cd", "xyz"], k=rng.randint(0, 9))) for _ in range(rng.randint(0, 12))) for _ in range(60)]
    assert fingerprints.encoded(*fingerprints.fingerprints(pa.array(texts))) == [plain_fingerprint(t) for t in texts]


def test_ranges_of_one_id_are_cut_by_bytes(spark):
    rows = [(None, f"null id {i} " * 5) for i in range(200)] + [(7, "the same text")] * 300 + [(8, f"other {i}") for i in range(50)] + [(1, "w " * 5000)]
    docs = documents(spark, rows, 7)
    got = fingerprints.fingerprint_documents(docs, 2000)
    assert Counter(r.doc_id for r in got.collect()) == Counter(i for i, _ in rows)
    assert sum(r.near_next == 1.0 for r in got.collect() if r.doc_id == 7) >= 299
    tasks = got.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(tasks) > 10 and max(r["count"] for r in tasks) < 80


def test_fingerprints_add_and_subtract():
    lines = [f"line {i} has words {i * 7 % 11}" for i in range(12)]
    one = lambda *parts: fingerprints.encoded(*fingerprints.fingerprints(pa.array(["\n".join(parts)])))[0]
    assert one(*lines) == one(*reversed(lines)) == fingerprints.combine(one(*lines[:5]), one(*lines[5:]))
    assert fingerprints.combine(one(*lines), one(lines[3]), -1) == one(*lines[:3], *lines[4:])
    assert one(*lines) != one(*lines, lines[0]) and one() == one("", " ")


def test_likeness_follows_the_share_in_common():
    words = [f"w{i}" for i in range(2000)]
    base = fingerprints.fingerprints(pa.array([" ".join(words)] * 3))
    other = fingerprints.fingerprints(pa.array([" ".join(words[:n] + [f"v{i}" for i in range(2000 - n)]) for n in (1800, 1000, 0)]))
    assert fingerprints.likeness(base, other) == pytest.approx([0.9, 0.5, 0.0], abs=0.2)


def test_words_of_a_long_text_hash_alike():
    text = LONG * 8
    (_, words), = pieces(pa.array([text]))
    (_, short), = pieces(pa.array([LONG]))
    assert len(words.data) > 3 << 20
    assert (words.hashes()[:50_000] == short.hashes()[:50_000]).all()
