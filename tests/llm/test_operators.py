"""Every operator against brute force on rows with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratiform.llm import decontamination, language_model, near_dedup, packing, quality_classifier, quality_rules, secrets, sharding, suffix_dedup, token_files
from stratiform.llm.elias_fano import EliasFano
from stratiform.llm.tokens import default_path, encoder

WORDS = re.compile(rb"[^\x20\x09-\x0d]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, shard int, node int, bucket int, score double, spans string, text_ string"


def words(text):
    return WORDS.findall((text or "").encode().lower())


def texts():
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("abcdeé ") for _ in range(rng.randint(1, 7))).replace(" ", "x") for _ in range(300)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    base = make(120)
    out = [None, "", "   \n\t", "one", "Two words", "a b c d", make(5), base, base, base.upper(), base + " tail", base.replace(" ", "  ")]
    for _ in range(12):  # near copies, and copies of near copies
        w = rng.choice(out[7:]).split()
        for _ in range(rng.randint(1, 4)):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        out.append(" ".join(w))
    passage = make(40)
    out += [make(rng.randint(1, 30)) + "\n" + passage + " " + make(rng.randint(1, 30)) for _ in range(12)]
    out += ["x" * 300, "x" * 333, "ab" * 400, make(9000), "na na " * 400, "é" * 120, "é" * 121, "line\nline\nline one two three four five", 'password = "hunter2hunter2"\nk = "aB3dE5fG7hJ9"\nclient_key = k', "AKIA" + "B" * 16, "0123456789abcdef01234567"]
    return out


@pytest.fixture(scope="module")
def rows():
    out = [(i * 3 % 101, t, ("en", None, "fr")[i % 3], ("s", None)[i % 2], None) for i, t in enumerate(texts())]
    out.append(out[7])  # a repeated row
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, 3, 0.5, "s", "t") for r in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def with_null_id(spark, docs):
    return docs.unionByName(spark.createDataFrame([(None, "an id that is null " * 9, None, None, None, 1, 2, 3, 0.5, "s", "t")] * 2, SCHEMA))


OPERATORS = [
    sharding.kd_shards,
    secrets.scan_secrets,
    language_model.score_documents,
    lambda d: quality_classifier.score_documents(d, d.select("doc_id", F.lit(1).alias("quality"))),
    quality_rules.apply_rules,
    suffix_dedup.remove_repeats,
    near_dedup.near_duplicates,
    lambda d: token_files.read_token_files(d.sparkSession, *token_files.write_token_files(d)),
]


def test_null_ids_in_leaks_and_pieces(spark, none, with_null_id):
    bench = spark.createDataFrame([(1, "id that is null an id that is null an id"), (None, "that is null")], "item_id long, text string")
    got = decontamination.find_leaks(with_null_id, bench)
    assert got.where("doc_id is null AND item_id = 1").count() == 2 and got.where("doc_id is null AND item_id is null").count() == 2
    assert decontamination.drop_leaks(with_null_id, bench).where("doc_id is null").count() == 0
    pieces = packing.pack_documents(with_null_id)
    assert pieces.where("doc_id is null").agg(F.sum("length")).first()[0] == 2 * pieces.where("doc_id is null").first()["doc_tokens"]
    assert packing.pack_documents(none).count() == decontamination.find_leaks(none, bench).count() == 0


@pytest.mark.parametrize("k", range(len(OPERATORS)))
def test_empty_table_and_null_ids(k, none, with_null_id):
    assert OPERATORS[k](none).count() == 0
    got = OPERATORS[k](with_null_id)
    assert got.count() == with_null_id.count() and got.where("doc_id is null").count() == 2


def test_shards(docs, rows):
    got = sharding.kd_shards(docs, 7).collect()
    size = lambda t: len((t or "").encode()) + 16
    assert sorted((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == sorted((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(7))


def test_shards_are_even(spark):
    d = spark.range(20000).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 97).cast("int")).alias("text"), F.lit("en").alias("lang"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), (F.col("id") % 11).cast("string"))).alias("source"))
    size = [r["b"] for r in sharding.kd_shards(d).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(size) == 40 and max(size) - min(size) < 0.05 * sum(size) / 40


def test_secrets(docs, rows):
    kinds = {"assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6), "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile(r"[0-9a-f]+"), 0, 24)}
    want = {}
    for doc, t, *_ in rows:
        spans = sorted((m.start(), i, m.end(), k) for i, (k, (p, g, n)) in enumerate(kinds.items()) for m in p.finditer(t or "") if len(m[g]) >= n)
        want[doc] = hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in spans).encode()).hexdigest()
    got = secrets.scan_secrets(docs).collect()
    assert {r["doc_id"]: r["base_sha256"] for r in got} == want
    assert sum(r["n_literal"] for r in got) == 1
    redacted = secrets.redact_secrets(docs)
    assert redacted.schema == docs.schema and redacted.where("text like '%hunter2%' or text like '%aB3dE5%'").count() == 0


@pytest.mark.parametrize("text,found", [('api = "Zx81jsA9s0Kq"', False), ('{"signing_key": "Zx81jsA9s0Kq"}', True), ("<password>S3cr3tPw99</password>", True), ("--token abcd1234EFGH", True), ('a = "Zx81" + "jsA9s0Kq"\npwd = a', True), ("pwd: the words", False)])
def test_assignments(text, found):
    assert any(k == "literal" for k, _, _ in secrets.scan_text(text)[1]) == found


def test_language_model(docs, rows):
    seen, t = [], {}
    for doc, text, *_ in rows:
        t[doc] = [*words(text), None]
        if zlib.crc32(str(doc).encode()) % 7 != 2:
            seen.append(t[doc])
    c, b = Counter(w for x in seen for w in x), Counter(p for x in seen for p in zip([None, *x], x, strict=False))
    n, v, mu = sum(c.values()), len(c), language_model.MU
    for r in language_model.score_documents(docs).collect():
        x = t[r["doc_id"]]
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in x)
        score = sum(math.log10(b[(p, w)] / (c[p] + mu) + mu / (c[p] + mu) * (c[w] + 1) / (n + v + 1)) for p, w in zip([None, *x], x, strict=False))
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(x), sum(c[w] > 0 for w in x), n)
        assert r["base_score"] == pytest.approx(base) and r["score"] == pytest.approx(score, rel=0.03)


@pytest.mark.parametrize("n,universe", [(0, 10), (1, 1), (5, 6), (2000, 10**6), (3000, 3001), (5000, 2**63)])
def test_elias_fano(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n, dtype=np.uint64))
    e = EliasFano(EliasFano.encode(values, universe))
    assert (e.get(np.arange(n)) == values).all()
    asked = np.concatenate([rng.integers(0, universe, 300, dtype=np.uint64), values[:100], np.array([universe - 1], np.uint64)])
    at, value = e.next_geq(asked)
    want = np.searchsorted(values, asked)
    assert (at == want).all() and (value[want < n] == values[want[want < n]]).all()


def leaks(rows, items):
    out = {}
    for doc, text, *_ in rows:
        w = words(text)
        for k, t in items:
            i = words(t)
            if not i:
                continue
            n = min(5, len(i))
            own = Counter(tuple(i[a : a + n]) for a in range(len(i) - n + 1))
            for a in range(len(w) - len(i) + 1):
                win = Counter(tuple(w[a + b : a + b + n]) for b in range(len(i) - n + 1))
                common = sum((own & win).values())
                if 4 * common >= 3 * (2 * sum(own.values()) - common):
                    out[(doc, k)] = max(out.get((doc, k), 0), common / (2 * sum(own.values()) - common))
    return out


def test_decontamination(spark, docs, rows, none):
    some = [r[1] for r in rows if r[1] and len(r[1].split()) > 60]
    cut = lambda t, a, n: " ".join(t.split()[a : a + n])
    items = [(0, cut(some[0], 3, 30)), (1, cut(some[-5], 10, 50).upper()), (2, None), (3, ""), (4, "two words"), (5, cut(some[0], 3, 30)), (6, "none of this is anywhere in there at all"), (7, cut(some[8], 0, 25))]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in decontamination.find_leaks(docs, bench).collect()}
    want = leaks(rows, items)
    assert got == pytest.approx(want)
    kept = decontamination.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and kept.count() == sum(r[0] not in {d for d, _ in want} for r in rows)
    assert decontamination.find_leaks(none, bench).count() == 0 and decontamination.find_leaks(docs, bench.limit(0)).count() == 0


def test_base_rules(docs, rows):
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(docs).collect()}
    for doc, text, *_ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        again = {i + j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(5)}
        seen, lines = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                lines += line in seen
                seen.add(line)
        r = got[doc]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), lines, len(again))
        assert r["base_failed"] == (len(w) < 10 or 100 * len(again) > 20 * len(w)) and not (r["base_failed"] and r["kept"])


def brute_model(texts):
    """log10 probability of a byte after the four before it, by modified Kneser-Ney over byte strings."""
    n = quality_rules.ORDER
    pad = lambda t: bytes(n - 1) + (t or "").encode()
    levels = {n: Counter(b[i : i + n] for b in map(pad, texts) for i in range(len(b) - n + 1))}
    for k in range(n - 1, 0, -1):
        levels[k] = Counter(g[1:] for g in levels[k + 1])
    cuts, totals = {}, {}
    for k, level in levels.items():
        t = [sum(c == j for c in level.values()) for j in (1, 2, 3, 4)]
        y = t[0] / (t[0] + 2 * t[1]) if min(t) else 0
        cuts[k] = [min(max(j - (j + 1) * y * t[j] / t[j - 1], 0.05), j - 0.05) for j in (1, 2, 3)] if min(t) else [0.5, 0.75, 0.9]
        totals[k] = {}
        for g, c in level.items():
            x = totals[k].setdefault(g[:-1], [0, 0.0])
            x[0] += c
            x[1] += cuts[k][min(c, 3) - 1]

    def p(g):
        if not g:
            return 1 / 256
        k, c = len(g), levels[len(g)][g]
        if g[:-1] not in totals[k]:
            return p(g[1:])
        total, mass = totals[k][g[:-1]]
        return (c - cuts[k][min(c, 3) - 1] if c else 0) / total + mass / total * p(g[1:])

    return lambda t: sum(math.log10(p(b[i : i + n])) for b in [pad(t)] for i in range(len(b) - n + 1)), p


def brute_quartiles(values):
    bins = sorted(math.floor(v / quality_rules.BIN) for v in values)
    return [(bins[math.ceil(q * len(bins)) - 1] + 0.5) * quality_rules.BIN for q in (0.25, 0.75)]


@pytest.mark.parametrize("most", [10**9, 0])
def test_perplexity_and_verdicts(spark, docs, rows, most):
    every = {lang: brute_model([r[1] for r in rows if r[2] == lang])[0] for lang in {r[2] for r in rows}}
    x = [(-every[r[2]](r[1]) / len(words(r[1])), -every[r[2]](r[1]) / len((r[1] or "").encode())) if words(r[1]) else None for r in rows]
    limits = {}
    for k in (0, 1):
        pool = brute_quartiles([v[k] for v in x if v])
        for lang in every:
            own = [v[k] for v, r in zip(x, rows, strict=True) if v and r[2] == lang]
            limits[lang, k] = [(len(own) * a + 20 * b) / (len(own) + 20) for a, b in zip(brute_quartiles(own), pool, strict=True)]
    got = {r["doc_id"]: r for r in quality_rules.apply_rules(docs, most).collect()}
    for r, v in zip(rows, x, strict=True):
        if not v:
            assert got[r[0]]["perplexity"] is None and not got[r[0]]["kept"]
            continue
        assert got[r[0]]["perplexity"] == pytest.approx(10 ** v[0], rel=1e-3) and got[r[0]]["byte_perplexity"] == pytest.approx(10 ** v[1], rel=1e-3)
        inside, near = True, False
        for k in (0, 1):
            q1, q3 = limits[r[2], k]
            width = 1.75 * max(q3 - q1, quality_rules.BIN) * math.sqrt(1 + 50 / len(words(r[1])))
            inside &= q1 - width <= v[k] <= q3 + width
            near |= min(abs(v[k] - q1 + width), abs(v[k] - q3 - width)) < 0.01
        assert near or got[r[0]]["kept"] == (inside and not got[r[0]]["base_failed"])


def test_perplexity_rejects_planted_junk(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    rng = random.Random(6)
    junk = [(10**6 + k, " ".join("".join(rng.choice("bcdfgjkqwxz0123456789@~^") for _ in range(rng.randint(2, 14))) for _ in range(60)), "en") for k in range(20)]
    got = quality_rules.apply_rules(d.unionByName(spark.createDataFrame(junk, "doc_id long, text string, lang string"))).toPandas().set_index("doc_id")
    assert not got.loc[[j[0] for j in junk]].kept.any() and got.base_failed.loc[[j[0] for j in junk]].sum() == 0
    clean = got[(got.index < 10**6) & ~got.base_failed]
    assert clean.kept.mean() > 0.85


def test_kneser_ney_sums_to_one(spark):
    text = "".join(random.Random(1).choice("abc d") for _ in range(400))
    model = quality_rules.Model(quality_rules.fit_model(spark.createDataFrame([(text, "x")], "text string, lang string")).toArrow())
    for context in (b"abca", b"zzzz", b"a b "):
        grams = int.from_bytes(context) * 256 + np.arange(256)
        assert (10 ** model.log10(":x", grams)).sum() == pytest.approx(1, abs=1e-3)


def test_classifier_holds_out(spark, sf):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    scored = quality_classifier.score_documents(d, labels).join(labels, "doc_id").where("held_out").toPandas()
    assert len(scored) and (scored["predicted"] == scored["quality"]).mean() >= 0.95 and scored["score"].between(0, 1).all()


def test_classifier_without_labels(docs, none):
    model = quality_classifier.fit_from_tables(docs, none.selectExpr("doc_id", "1 quality"))
    assert model.weights is None and model.prior == 0.5


def removed(rows):
    first = {}
    for doc, text, *_ in rows:
        b = (text or "").encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(doc, first.get(b[i : i + 50], doc))
    out = []
    for doc, text, *_ in rows:
        b = (text or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < doc:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((doc, len(b), sum(gone), sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1])), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("hot", [20_000, 2])
def test_repeats(docs, rows, hot, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    assert sorted(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == removed(rows)


def test_deep_shallow_sort():
    rng = random.Random(2)
    strings = [bytes(rng.choice(b"ab") if i > 33 else 97 for i in range(50)) for _ in range(200)] + [bytes(rng.choice(b"abc") for _ in range(50)) for _ in range(200)]
    group = np.array([rng.randint(0, 3) for _ in strings])
    order, lcp = suffix_dedup.deep_shallow_sort(group, np.frombuffer(b"".join(strings), np.uint8).reshape(-1, 50))
    keys = [(group[k], strings[k]) for k in order]
    assert keys == sorted(keys)
    for k in range(1, len(keys)):
        same = next((i for i, (a, b) in enumerate(zip(keys[k][1], keys[k - 1][1], strict=True)) if a != b), 50)
        assert lcp[k] == (same if keys[k][0] == keys[k - 1][0] else -1)


def test_near_duplicates(docs, rows):
    sets, parent = {}, {}
    for doc, text, *_ in rows:
        w = words(text)
        sets[doc] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} - {()}
        parent[doc] = doc

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    got = near_dedup.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(sets[r["doc_id"]]), find(r["doc_id"]), r["doc_id"] == find(r["doc_id"]))
    kept = near_dedup.keep_one(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted({find(d) for d in sets}) and kept.columns == docs.columns


def ids(text, end):
    return np.array([*encoder(default_path()).whole.encode(text or "", add_special_tokens=False).ids, end], np.uint32)


def test_encoder_equals_library():
    odd = ["", " ", "a  b\x0b c\x1cd", "é é İstanbul ΑΣ Σ", "<|endoftext|> x<|startoftext|>y", "don't DON'T it's12", "a\xa0b ﬁ À×÷ªº¼ßẞ", "'S'T ''d 'll'm 日本語 🙂🙂", "naïve, (x)."]
    flat, offsets = encoder(default_path()).encode(pa.array(odd))
    for k, t in enumerate(odd):
        assert flat[offsets[k] : offsets[k + 1]].tolist() == ids(t, 0)[:-1].tolist()


def test_token_files(docs, rows):
    got = sorted(token_files.read_token_files(docs.sparkSession, *token_files.write_token_files(docs)).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(r[0] for r in rows)
    text, start = {r[0]: r[1] for r in rows}, 0
    for r in got:
        want = ids(text[r["doc_id"]], 2)
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(want), zlib.crc32(want.tobytes()))
        start += len(want)


def test_varbyte():
    ranks = np.array([0, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1, 7], np.uint32)
    assert (token_files.decode_ranks(*token_files.encode_ranks(ranks), len(ranks)) == ranks).all()


def test_packing(docs, rows, none):
    got = packing.pack_documents(docs, with_ids=True).collect()
    pieces, windows = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        windows.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(np.array(r["ids"], np.uint32).tobytes()) == r["ids_crc32"]
    text, often = {r[0]: r[1] for r in rows}, Counter(r[0] for r in rows)
    for doc, own in pieces.items():
        want = ids(text[doc], 1).tolist()
        assert sorted((r["start"] + k, t) for r in own for k, t in enumerate(r["ids"])) == sorted((k, t) for k, t in enumerate(want) for _ in range(often[doc]))
    total = 0
    for own in windows.values():
        own.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in own] == np.cumsum([0, *(r["length"] for r in own)])[:-1].tolist()
        total += sum(r["length"] for r in own)
        assert sum(r["length"] for r in own) <= packing.LENGTH
    assert len(windows) * packing.LENGTH - total < packing.LENGTH * 5  # one window a partition at most
    assert packing.pack_documents(none).count() == 0


def test_sum_of_squares_chooses_least():
    rng = random.Random(3)
    packer = packing.SumOfSquares(50)
    levels = Counter()
    for k in range(400):
        size = rng.randint(1, 49)
        options = {}
        for h in range(50 - size + 1):
            if h == 0 or levels[h]:
                after = levels.copy()
                after[h] -= h > 0
                after[h + size] += h + size < 50
                options[h] = sum(c * c for c in after.values())
        before = {h: len(w) for h, w in packer.open.items()}
        packer.put(k, 0, size)
        now = Counter({h: len(w) for h, w in packer.open.items() if w})
        assert sum(c * c for c in now.values()) == min(options.values()), before
        levels = now


def near_components(spark, texts):
    """Components by brute force, and those of the operator."""
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in texts]
    want = list(range(len(texts)))
    for b in range(len(texts)):
        for a in range(b):
            if want[a] != want[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                low, high = sorted((want[a], want[b]))
                want = [low if x == high else x for x in want]
    table = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in near_dedup.near_duplicates(table).collect()}
    return want, [got[i] for i in range(len(texts))]


def edited(rng, text, runs, width=3):
    """The text with runs of new words at random places."""
    out = list(text)
    for _ in range(runs):
        k = rng.randrange(len(out) - width)
        out[k : k + width] = [f"n{rng.random()}" for _ in range(width)]
    return out


def bands_of(text):
    return near_dedup.band_keys(near_dedup.signature(near_dedup._sets(pa.array([" ".join(text)]))))[0]


def rarely_together(rng):
    """A pair just above the limit that shares few buckets, and the places of the words that make those."""
    while True:
        x = [f"w{rng.random()}" for _ in range(1500)]
        y = edited(rng, x, 33)
        a, b = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in (x, y))
        shared = np.flatnonzero(bands_of(x) == bands_of(y))
        gaps = np.diff(np.append(shared, shared[:1] + near_dedup.BANDS))
        if 100 * len(a & b) >= 75 * len(a | b) and 0 < len(shared) <= 5 and gaps.min() > 3:
            whole = near_dedup.signature(near_dedup._sets(pa.array([" ".join(x)])))[0].reshape(-1, near_dedup.BAND_BINS)
            hashes = near_dedup.shingles(*near_dedup.word_hashes(pa.array([" ".join(x)])))[0]
            return x, y, shared, [int(np.flatnonzero(hashes == h)[0]) for h in whole[shared].ravel()]


def test_near_duplicates_behind_an_unrelated_centre(spark):
    """The least doc of every bucket that a pair shares is similar to neither."""
    rng = random.Random(3)
    x, y, shared, places = rarely_together(rng)
    while True:
        centre = [w for p in places for w in [f"s{rng.random()}", *x[p : p + 5]]]
        if (bands_of(centre)[shared] == bands_of(x)[shared]).all():
            break
    want, got = near_components(spark, [centre, x, y])
    assert want == [0, 1, 1] and got == want


def test_near_duplicates_behind_a_linked_centre(spark):
    """The least doc of every bucket that a pair shares is similar to one of the two only."""
    rng = random.Random(4)
    x, y, shared, _ = rarely_together(rng)
    while True:
        centre = edited(rng, x, 12)
        if (bands_of(centre)[shared] == bands_of(x)[shared]).all():
            break
    want, got = near_components(spark, [centre, x, y])
    assert want == [0, 0, 0] and got == want


@pytest.mark.parametrize("runs", [5, 4])
def test_near_duplicates_of_related_texts(spark, runs):
    """Pairs just above the limit in crowds of related texts below it."""
    rng = random.Random(11)
    texts, pairs = [], []
    for g in range(4):
        base = [f"w{g}_{i}" for i in range(300)]
        texts += [edited(rng, base, runs) for _ in range(50)]
        for _ in range(20):
            x = edited(rng, base, runs)
            pairs += [x, edited(rng, x, 6)]
    want, got = near_components(spark, texts + pairs)
    assert got == want


def test_shards_split_equal_rows(spark):
    same = [(7, "one text that many rows share", "en", "hot")] * 1500
    d = spark.createDataFrame([*same, *((k, f"t{k}", "fr", f"s{k % 30}") for k in range(500))], "doc_id long, text string, lang string, source string")
    got = sharding.kd_shards(d, 8)
    size = [r["b"] for r in got.groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(size) == 8 and max(size) - min(size) < 0.05 * sum(size) / 8
    assert "ExistingRDD" not in got._jdf.queryExecution().toString() and "Python" not in got._jdf.queryExecution().toString()


def brute_shards(rows, shards):
    """The K-d tree over exact keys, on the driver."""
    ranks = [{v: k + 1 for k, v in enumerate(sorted({r[c] or "" for r in rows}))} for c in (2, 3)]
    points = [(ranks[0][r[2] or ""], ranks[1][r[3] or ""], math.log2(len((r[1] or "").encode()) + 16), float(r[0] or 0)) for r in rows]
    wide = [max(p[d] for p in points) - min(p[d] for p in points) or 1 for d in range(4)]
    out = {}

    def split(own, first, n):
        if n == 1:
            out.update(dict.fromkeys(own, first))
            return
        d = max(range(4), key=lambda d: ((max(points[k][d] for k in own) - min(points[k][d] for k in own)) / wide[d], -d))
        own = sorted(own, key=lambda k: points[k][d])
        sizes = np.cumsum([len((rows[k][1] or "").encode()) + 16 for k in own])
        cut = int(np.argmin(np.abs(sizes - sizes[-1] * (n // 2) / n))) + 1
        split(own[:cut], first, n // 2)
        split(own[cut:], first + n // 2, n - n // 2)

    split(list(range(len(rows))), 0, shards)
    return out


def test_shards_follow_the_tree(spark):
    rng = random.Random(8)
    # languages are the widest, then sources; sizes and ids are distinct, so no cut lies among equal values
    rows = [(1000 + k, "x" * (k * 7 % 401), "en", "s") for k in range(200)]
    rng.shuffle(rows)
    got = {r["doc_id"]: r["shard"] for r in sharding.kd_shards(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), 4).collect()}
    want = brute_shards(rows, 4)
    assert sum(got[r[0]] == want[k] for k, r in enumerate(rows)) >= 196  # a key keeps 16 bits of a value


def test_near_duplicates_with_two_texts_for_an_id(spark):
    rng = random.Random(4)
    a, b = ([f"w{rng.random()}" for _ in range(60)] for _ in range(2))
    rows = [(5, " ".join(a)), (5, " ".join(b)), (1, " ".join([*a, "tail"])), (9, " ".join([*b, "tail"])), (3, " ".join(f"w{rng.random()}" for _ in range(60)))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == [(1, 1), (3, 3), (5, 1), (5, 1), (9, 1)]


def test_multikey_quicksort():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 4, (700, 3), dtype=np.uint64)
    group = rng.integers(0, 5, 700)
    order, run = suffix_dedup.multikey_quicksort(words, group, 2)
    keys = [(group[k], *words[k, :2].tolist()) for k in order]
    assert keys == sorted(keys) and run.tolist() == [sorted(set(keys)).index(k) for k in keys]


@pytest.mark.parametrize(
    "text,found",
    [
        ('passphrase = "correcthorsebatterystaple"', ["correcthorsebatterystaple"]),
        ("db_pwd: 8392017465", ["8392017465"]),
        ("DSN = postgres://admin:Zk29fjQx@db.local/x", ["Zk29fjQx"]),
        ('credential = \\\n  "Qk83jdLs92" +\n  "mmZ81xPq"', []),
        ('credential =\n  "Qk83jdLs92" +\n  "mmZ81xPq"', ["Qk83jdLs92", "mmZ81xPq"]),
        ("\n".join([f'a{k} = {f"a{k - 1} + " if k else ""}"p{k}Q{k * 7919}"' for k in range(200)] + ["signing_key = a199"]), [f"p{k}Q{k * 7919}" for k in range(200)]),
        ('x = "Ab3"\n' + "x = x + x\n" * 60 + "private_key = x", ["Ab3"]),
        ("the passphrase: forgotten again", []),
        ("note: see the appendix, chapter 12", []),
    ],
)
def test_planted_literals(text, found):
    assert [text[a:b] for k, a, b in secrets.scan_text(text)[1] if k == "literal"] == found


def test_planted_secrets_precision_and_recall(spark):
    rng = random.Random(12)
    alphabet = "ABCDEFGHJKLMNPQRSTUVWXYZabcdefghjkmnpqrstuvwxyz23456789"
    rows, planted = [], {}
    clean = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for k, t in enumerate(clean):
        value = "".join(rng.choice(alphabet) for _ in range(20))
        line = ('client_secret_key = "{}"', "<passphrase>{}</passphrase>", 'x{k} = "{}"\ncredential = x{k}', '{{"signing-key": "{}"}}', "run --private-key {}")[k % 5].format(value, k=k)
        rows.append((k, f"{t}\n{line}\n" if k % 2 else t))
        if k % 2:
            planted[k] = value
    base = {k: len([s for s in secrets.scan_text(t)[1] if s[0] == "literal"]) for k, t in enumerate(clean)}
    caught = extra = 0
    for k, t in rows:
        spans = [t[a:b] for kind, a, b in secrets.scan_text(t)[1] if kind == "literal" or planted.get(k, "\0") in t[a:b]]
        caught += any(planted.get(k, "\0") in s for s in spans)
        extra += len([s for s in spans if planted.get(k, "\0") not in s])
    assert caught >= 0.98 * len(planted) and extra == sum(base.values()) == 0


def test_other_tokenizers_encode_whole_texts():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    e = encoder(path)
    texts = ["The quick brown fox, jumps over it.", "", "  two  spaces "]
    flat, offsets = e.encode(pa.array(texts))
    for k, t in enumerate(texts):
        assert flat[offsets[k] : offsets[k + 1]].tolist() == e.whole.encode(t, add_special_tokens=False).ids


def naive_score(w, x):
    """One bag, passage by passage."""
    h = [np.tanh(v @ w["E"] + w["e"]) for v in x]
    logits = [float(sum(np.tanh(v @ w["V"])[j] / (1 + math.exp(-(v @ w["U"])[j])) * w["w"][j] for j in range(len(w["w"])))) for v in h]
    top = max(logits)
    a = [math.exp(g - top) for g in logits]
    z = sum(k / sum(a) * v for k, v in zip(a, h, strict=True))
    return 1 / (1 + math.exp(-float(z @ w["c"] + w["d"])))


def test_attention_forward_and_gradients():
    rng = np.random.default_rng(0)
    sizes = [1, 4, 2, 7]
    bags = np.concatenate([[0], np.cumsum(sizes)])
    x, y = rng.normal(size=(sum(sizes), quality_classifier.FEATURES)), np.array([0.0, 1.0, 1.0, 0.0])
    f, h, g = quality_classifier.FEATURES, quality_classifier.HIDDEN, quality_classifier.GATE
    w = {"E": rng.normal(0, 0.1, (f, h)), "e": rng.normal(0, 0.1, h), "V": rng.normal(0, 0.2, (h, g)), "U": rng.normal(0, 0.2, (h, g)), "w": rng.normal(0, 0.5, g), "c": rng.normal(0, 0.5, h), "d": np.array(0.1)}
    got = quality_classifier._forward(w, x, bags)["p"]
    assert got == pytest.approx([naive_score(w, x[a:b]) for a, b in zip(bags[:-1], bags[1:], strict=True)])
    loss = lambda: float(-np.mean(y * np.log(p := quality_classifier._forward(w, x, bags)["p"]) + (1 - y) * np.log(1 - p)))
    grads = quality_classifier._gradients(w, x, bags, y)
    for name, grad in grads.items():
        for place in [tuple(rng.integers(0, n) for n in w[name].shape) for _ in range(3)]:
            old, step = w[name][place], 1e-5
            w[name][place] = old + step
            up = loss()
            w[name][place] = old - step
            down = loss()
            w[name][place] = old
            assert grad[place] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_classifier_sample_is_whole_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    fit, held = quality_classifier.fit, []
    quality_classifier.fit = lambda x, bags, y: held.append((x, bags, y)) or fit(x, bags, y, epochs=1)
    try:
        quality_classifier.fit_from_tables(d, labels, 30)
        quality_classifier.fit_from_tables(d, labels, 30, 60)
    finally:
        quality_classifier.fit = fit
    (_, many, y1), (_, few, y2) = held
    assert len(y1) <= 30 and 0 < len(y2) < len(y1) and few[-1] <= 60
    assert set(np.diff(few)) <= set(np.diff(many))


def leak_items(d):
    return d.sparkSession.createDataFrame([(0, "one passage that is in the very long text only and nowhere else at all")], "item_id long, text string")


LONG = [*OPERATORS, lambda d: decontamination.find_leaks(d, leak_items(d)), packing.pack_documents]


@pytest.mark.parametrize("k", range(len(LONG)))
def test_text_over_many_slices(k, spark):
    """A text of 6 MB beside rows that fill several slices."""
    rng = random.Random(k)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(5000)]
    make = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    long = make(500_000) + " one passage that is in the very long text only and nowhere else at all " + make(500_000)
    rows = [(0, long, "en", "s"), *((i, make(800), "en", "s") for i in range(1, 900)), (900, long[: len(long) // 2], "en", "s")]
    got = LONG[k](spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1))
    if k == len(OPERATORS):
        assert [r["doc_id"] for r in got.collect()] in ([0], [0, 900])
    else:
        assert got.select("doc_id").distinct().count() == 901
