"""The training-data operators against brute force, and on empty, null, repeated and odd rows."""

import base64
import gzip
import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from rowkin.llm import chat, exact_dedup, language_id, lm_scoring, mixing, near_dedup, packing, quality_classifier, quality_rules, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(rng, n, size=400):
    return [f"w{rng.randrange(size)}" for _ in range(n)]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows."""
    r = random.Random(4)
    long = " ".join(words(r, 20_000, 5000))
    rows = [(1, "a b\tc", "en", "s", 5), (2, "abc", "en", "s", 3), (3, "ab c ", "de", None, 5), (3, "ab c ", "de", None, 5), (4, None, None, "s", None), (5, "", "fr", "t", 0), (None, "lonely text of five words", "en", "t", 1), (None, None, None, None, None), (6, long, "en", "s", 1), (7, long + " x", "en", "t", 1), (8, "\x0b \n", "fr", "é", 3), (9, "naïve ‘quotes’ 中文 and 😀 <|endoftext|> don't", "en", "t", 9)]
    return spark.createDataFrame(rows, DOCS).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df):
    """Further columns with the names that operators use inside."""
    extra = ("_row", "_id", "_text", "node", "words", "key", "source_size", "ids", "_turn", "score")
    return df.withColumns({c: F.lit("mine") for c in extra if c not in df.columns})


def counts(text):
    found, text = WORD.findall(text or ""), text or ""
    at = defaultdict(list)
    for i in range(len(found) - 4):
        at[tuple(found[i : i + 5])].append(i)
    covered = {j for v in at.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, odd, none):
    r = random.Random(1)
    texts = ["\n".join(" ".join(words(r, r.randint(0, 9), r.choice([2, 3, 40]))) for _ in range(r.randint(0, 12))) + r.choice(["", " ### |", "\t"]) for _ in range(120)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for made in (quality_rules.judged(docs).collect(),):
        for x in made:
            want = counts(texts[x.doc_id])
            assert tuple(x[c] for c in columns) == want
            assert x.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
            assert x.kept == (x.rejected_by is None) and not (x.kept and x.base_failed)
    names = list(quality_rules.rules())
    kept = [{(x.doc_id, x.kept) for x in quality_rules.judged(docs, order=o).collect()} for o in (names, names[::-1])]
    assert kept[0] == kept[1]  # the order sets the cost, not the verdict
    # b costs least for what it rejects; c rejects less than a, but of rows that b leaves.
    patterns = [(0b011, 10), (0b100, 4), (0b001, 1), (0, 50)]
    assert quality_rules.ordered(["a", "b", "c"], patterns, {"a": 1.0, "b": 0.1, "c": 0.5}) == ["b", "c", "a"]
    sample = quality_rules.counted(docs).persist()
    found = quality_rules.rules()
    rejected = quality_rules.rejections(sample, found)
    assert sum(n for _, n in rejected) == sample.where("NOT base_failed").count()
    for k, rule in enumerate(found.values()):
        assert sum(n for p, n in rejected if p >> k & 1) == sample.where("NOT base_failed").where(rule).count()
    assert all(x > 0 for x in quality_rules.costs(sample.limit(20), {k: found[k] for k in ("symbols", "capitals")}).values())
    sample.unpersist()
    assert quality_rules.judged(none).count() == 0
    got = quality_rules.judged(clashing(odd)).collect()
    assert len(got) == odd.count() and all(x.base_failed for x in got if x.doc_id in (1, 4, 5, 8))


def by_sql(name, rows, tmp_path):
    """Rows of a query's SQL over a table of documents."""
    import duckdb
    import pyarrow.parquet as pq

    from rowkin.llm import queries

    pq.write_table(pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": pa.array([t for _, t in rows], pa.string())}), tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS FROM '{tmp_path}/documents.parquet'")
    return con.execute(queries.ORACLE_SQL[name]).df()


def test_quality_rules_and_their_sql_agree(spark, tmp_path):
    """Acronyms, other scripts, ends of lines, bullets: the cascade says what the SQL says."""
    r = random.Random(17)
    parts = ["U.S.", "A.B.C", "NATO", "Ünïted", "ÄÖ", "été", "x1", "12", "...", "…", "#", "|", "-", "*", "•", "word", "longer", "ΑΒΓ", "中文", "don't", "iPHONE", "a" * 30]
    rows = [(0, None), (1, ""), (2, " \x0b\r\n")]
    for i in range(3, 900):
        some = r.sample(parts, r.randint(2, 8)) + [f"w{k}" for k in range(r.choice([0, 0, 40]))]
        lines = []
        for _ in range(r.randint(1, 12)):
            line = r.choice(["", "", "- ", " • ", "*\t", "-"]) + r.choice([" ", "\t", "\x0b"]).join(r.choice(some) for _ in range(r.randint(0, 9)))
            lines.append(line + r.choice(["", "", "...", "…", "... ", "…\r", "...\x0b", "\r", "\u0085", "...\u0085"]))
        rows.append((i, r.choice(["\n", "\n", "\r\n"]).join(lines)))
    want = by_sql("op1_quality_rules", rows, tmp_path).set_index("doc_id").sort_index()
    got = quality_rules.judged(spark.createDataFrame(rows, "doc_id long, text string")).select(*["doc_id", *want.columns]).toPandas().set_index("doc_id").sort_index()
    assert got.equals(want.astype(got.dtypes.to_dict())) and 20 < got.kept.sum() < 800


def test_exact_dedup(odd, none):
    made = exact_dedup.groups(odd).collect()
    assert len(made) == odd.count() == sum(1 for _ in made)
    by = {x.doc_id: x for x in made if x.doc_id is not None}
    assert by[1].keep_id == by[2].keep_id == by[3].keep_id == 1 and by[1].group_size == 4 and by[1].kept and not by[2].kept
    assert by[1].text_sha256 == hashlib.sha256(b"abc").hexdigest() and by[4].group_size == 4 and by[8].kept
    kept = exact_dedup.deduplicate(clashing(odd))
    assert kept.columns == clashing(odd).columns
    ids = sorted((x.doc_id is None, x.doc_id or 0) for x in kept.collect())
    assert ids == [(False, i) for i in (1, 6, 7, 8, 9)] + [(True, 0)]
    assert exact_dedup.groups(none).count() == 0 and exact_dedup.deduplicate(none).count() == 0


def test_exact_dedup_beyond_a_broadcast(spark, odd, monkeypatch):
    monkeypatch.setattr(exact_dedup, "checked", lambda df: df)
    kept = exact_dedup.deduplicate(odd)
    assert sorted((x.doc_id is None, x.doc_id or 0) for x in kept.collect()) == [(False, i) for i in (1, 6, 7, 8, 9)] + [(True, 0)]


def test_exact_dedup_of_many_copies(spark):
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot text").otherwise(F.concat(F.lit("t"), F.floor(F.col("id") / 2))).alias("text")).repartition(7)
    made = exact_dedup.groups(docs).toPandas()
    assert (made[made.doc_id % 3 == 0].group_size == 1000).all() and made.kept.sum() == made.text_sha256.nunique()


def targets_by_hand(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """source: target, by dealing out and resharing; ``sizes``: (source, size)."""
    rows = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {k: weights[i % 3] for i, (k, _) in enumerate(rows)}
    out, open_, left = {k: 0.0 for k, _ in rows}, {k: z for k, z in rows if z}, share * sum(z for _, z in rows)
    while open_:
        total = sum(weight[k] for k in open_)
        over = [k for k, z in open_.items() if left * weight[k] / total > limit * z]
        if not over:
            out |= {k: left * weight[k] / total for k in open_}
            break
        for k in over:
            out[k] = limit * open_[k]
        left, open_ = left - sum(out[k] for k in over), {k: z for k, z in open_.items() if k not in over}
    return out


def test_mixing_targets(spark):
    make = lambda rows: {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, source_size long")).collect()}
    t = make([("b", 100), (None, 100), ("a", 1000), ("é", 0)])
    assert t["b"] == 200 and t[None] == 200 and t["a"] == pytest.approx(1400) and t["é"] == 0
    assert make([]) == {} and make([("a", 0)]) == {"a": 0}
    r = random.Random(24)
    for n in (1, 2, 7, 40):
        rows = [(f"s{i}{chr(r.randrange(32, 0x2000))}" if i else None, r.choice([0, 5, 100, 10_000, 333])) for i in range(n)]
        assert make(rows) == pytest.approx(targets_by_hand(rows))


def test_mixing(spark, odd, none):
    r = random.Random(2)
    rows = [(i, " ".join(words(r, int(r.paretovariate(1) * 5) + 1)), "en", f"s{min(i % 17, 6)}" if i % 50 else None, 0) for i in range(1500)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    made = mixing.mix(docs).toPandas()
    assert len(made) == 1500 and (made.copies <= 2).all() and (made.copies >= 0).all()
    taken = (made.copies * made["size"]).groupby(made["_source"].fillna("~")).sum()
    target = made.groupby(made["_source"].fillna("~")).target.first()
    assert ((taken - target).abs() <= 0.02 * target + 5).all()
    again = mixing.mix(docs.repartition(3)).toPandas()
    assert dict(zip(made.doc_id, made.copies)) == dict(zip(again.doc_id, again.copies))
    whole = mixing.repeated(docs).groupBy("doc_id").count().toPandas()
    assert dict(zip(whole.doc_id, whole["count"])) == {i: k for i, k in zip(made.doc_id, made.copies) if k}
    assert mixing.mix(odd).count() == odd.count() and mixing.mix(none).count() == 0 and mixing.repeated(none).count() == 0
    assert mixing.repeated(clashing(odd)).columns == clashing(odd).columns


def test_mixing_duals_by_bisection(spark):
    """The duals solve the token constraints, and the copies carry no more than their rounding errors."""
    r = random.Random(23)
    rows = [(f"s{i % 3}" if i % 3 else None, r.randint(0, 60)) for i in range(400)]
    hist = Counter(rows)
    totals = Counter()
    for (k, z), n in hist.items():
        totals[k] += z * n
    docs_of = Counter(k for k, _ in rows)
    goal = {None: 0.4, "s1": 1.3, "s2": 1.9}
    classes = [(k, z, n, totals[k], goal[k] * totals[k], totals[k] / docs_of[k]) for (k, z), n in hist.items()]
    made = {x.source: x.dual for x in mixing.duals(spark.createDataFrame(classes, "source string, size long, n long, source_size long, target double, mean double")).collect()}
    for k in goal:
        tokens = lambda dual: sum(n * z * min(2.0, np.exp(min(dual * z / mean, 50))) for s, z, n, _, _, mean in classes if s == k)  # noqa: E731, B023
        low, high = -50.0, 50.0
        for _ in range(100):
            low, high = (low, (low + high) / 2) if tokens((low + high) / 2) > goal[k] * totals[k] else ((low + high) / 2, high)
        assert tokens(made[k]) == pytest.approx(tokens(low), rel=2e-4) and tokens(made[k]) == pytest.approx(goal[k] * totals[k], rel=2e-4)
    part = pd.DataFrame({"source": "x", "size": [50, 20, 7, 0], "n": [10, 30, 100, 5], "rate": [0.33, 1.21, 0.07, 1.0], "limit": 2})
    copies = mixing.rounded(part)
    assert abs((copies.copies * copies["size"]).sum() - (part.n * part.rate * part["size"]).sum()) <= 7 and (copies.copies <= 2 * part.n).all()


def test_mixing_counts_beyond_64_bits_and_rows_without_ids(spark):
    rows = [(None, "one two", "en", "s", 0)] * 300 + [(None, "a b c", "en", "t", 0)] * 10 + [(i, "a b", "en", "t", 0) for i in range(20)]
    made = mixing.mix(spark.createDataFrame(rows, DOCS).repartition(4)).toPandas()
    assert len(made) == 330 and made.copies.max() <= 2
    taken = (made.copies * made["size"]).groupby(made["_source"]).sum()
    assert (taken - made.groupby("_source").target.first()).abs().max() <= 5
    big = spark.createDataFrame([(3 * 10**9, 4 * 10**9, 5 * 10**9)], "_k long, _upto long, n long")
    assert big.selectExpr("CAST(_k AS DECIMAL(19, 0)) * CAST(_upto AS DECIMAL(19, 0)) div CAST(n AS DECIMAL(19, 0)) AS q").first().q == 24 * 10**8


def test_chat(spark):
    tricky = [r"\### Assistant: </turn> ok", "<turn></role></turn>\\", "", None, "<|endoftext|> é中😀\n\t \\\\<", "a" * 50_000, "</turn" + ">"]
    rows = [(c, t, role, x) for c in (1, 2) for t, (role, x) in enumerate(zip(["user", "assistant", "assistant", None, "assistant", "tool </turn>", "assistant"], tricky))] + [(None, None, "assistant", "x"), (3, 0, "user", None)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    got = {r.conv_id: r for r in chat.read_back(chat.formatted(turns, BYTE_BPE), BYTE_BPE).collect()}
    assert set(got) == {None, 1, 2, 3}
    own = [(r or "", x or "") for _, _, r, x in rows if _ is not None][:7]
    assert got[1].n_turns == 7 and got[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in own).encode()).hexdigest()
    loss = "".join(x for r, x in own if r == "assistant")
    assert got[1].loss_chars == len(loss) and got[1].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    for x in tricky:
        if x is not None:
            assert chat.unescape(chat.escape(x)) == x and not any(c in chat.escape(x) for c in chat.CONTROL)
    assert got[3].loss_chars == 0 and chat.formatted(turns.limit(0), BYTE_BPE).count() == 0
    assert chat.read_back(chat.formatted(turns.limit(0), BYTE_BPE), BYTE_BPE).count() == 0
    again = turns.where("conv_id = 2").unionByName(turns.where("conv_id = 2 AND turn = 1")).withColumns({"ids": F.lit("mine"), "loss_mask": F.lit(1)})
    twice = chat.read_back(chat.formatted(again, BYTE_BPE), BYTE_BPE).first()
    order = [0, 1, 1, 2, 3, 4, 5, 6]  # a row that repeats another is a turn of its own, beside it
    assert twice.n_turns == 8 and twice.turns_sha256 == hashlib.sha256("".join("{}\n{}\n".format(*own[i]) for i in order).encode()).hexdigest()


def test_language_id(spark, odd, none):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn("held_out", language_id.held_out())
    profiles = language_id.learn(d.where("NOT held_out"))
    made = language_id.identified(d, profiles, keep=("held_out", "lang")).where("held_out").toPandas()
    assert (made.lang == made.lang_pred).mean() >= 0.98 and made.score.between(0, 1).all()
    got = {x.doc_id: x for x in language_id.identified(odd, profiles).collect()}
    assert got[4].lang_pred == got[5].lang_pred == got[8].lang_pred == "und" and got[6].lang_pred != "und"
    assert language_id.learn(none) == {} and language_id.identified(none, {}).count() == 0
    assert Counter(language_id.grams("ab, a").tolist()) == Counter([97, 98, 97] + [95 << 21 | 97, 97 << 21 | 98, 98 << 21 | 95, 95 << 21 | 97, 97 << 21 | 95] + [(95 << 21 | 97) << 21 | 98, (97 << 21 | 98) << 21 | 95, (98 << 21 | 95) << 21 | 97, (95 << 21 | 97) << 21 | 95])


def test_language_distance_by_hand(spark, odd):
    r = random.Random(18)
    texts = ["".join(r.choice("abc d") for _ in range(r.randint(1, 400))) for _ in range(60)]
    profiles = {k: language_id.ranked(language_id.grams(t)) for k, t in zip("xyz", texts)}
    ready = {k: (v[o := np.argsort(v)], o) for k, v in profiles.items()}
    for t in texts:
        codes = Counter(language_id.grams(t).tolist())
        own = sorted(codes, key=lambda c: (-codes[c], c))[: language_id.TOP]
        assert language_id.ranked(language_id.grams(t)).tolist() == own
        far = {k: sum(min(abs(v.tolist().index(c) - i), language_id.TOP) if c in v else language_id.TOP for i, c in enumerate(own)) for k, v in profiles.items()}
        want = min(far, key=lambda k: (far[k], k)) if own else "und"
        lang, score = language_id.predict(t, ready)
        assert lang == want and (not own or score == pytest.approx(1 - far[want] / (language_id.TOP * len(own))))
    more = clashing(odd).withColumns({"lang_pred": F.lit(1), "letters": F.lit(2)})
    assert language_id.identified(more, profiles).columns == ["doc_id", "lang_pred", "score"] and language_id.identified(more, profiles).count() == odd.count()


def test_quality_classifier(spark, odd, none):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    learn, held = labels.where("doc_id % 2 = 0"), labels.where("doc_id % 2 = 1")
    made = quality_classifier.resampled(docs, learn).join(held, "doc_id").toPandas()
    assert made[made.quality == 1].kept.mean() >= 0.97 and made[made.quality == 0].kept.mean() <= 0.15
    keys = spark.createDataFrame([(int(x),) for x in [5, 5, -3, 9, 2**40]], "key long")
    assert [quality_classifier.kth_largest(keys, k) for k in (0, 1, 2, 3, 4, 5, 6)] == [None, 2**40, 9, 5, 5, -3, None]
    kept = quality_classifier.selected(clashing(odd), labels, share=1.0)
    assert kept.columns == clashing(odd).columns and kept.count() == odd.count()
    assert quality_classifier.resampled(none, labels).count() == 0 and quality_classifier.resampled(odd, labels.limit(0)).where("kept").count() == odd.count()


def test_quality_model_by_brute_force(spark):
    """Counts of hashed words and pairs, their log ratio, and a whole text's sum, against plain counting; Gumbel noise by its definition."""
    r = random.Random(19)
    texts = [" ".join(words(r, r.randint(0, 30), 12)) for _ in range(80)] + [None, "a a a b"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 60, 3)], "doc_id long, quality int")
    ratios, share = quality_classifier.fit(docs, labels)
    good = {i for i in range(0, 60, 3) if i % 2}
    counts = np.zeros((2, quality_classifier.BUCKETS))
    for i, t in enumerate(texts):
        w = (t or "").split()
        w = [zlib.crc32(x.encode()) if j == 0 or x != w[j - 1] else 1 for j, x in enumerate(w)]
        for key in [*w, *[x << 32 | y for x, y in zip(w, w[1:])]]:
            at = int(near_dedup.mix64(np.array([key], np.uint64))[0] % np.uint64(quality_classifier.BUCKETS))
            counts[:, at] += (1, i in good)
    raw = (counts[0] + 1) / (counts[0].sum() + quality_classifier.BUCKETS)
    want = np.log((0.9 * counts[1] / counts[1].sum() + 0.1 * raw) / raw)
    assert np.allclose(ratios, want) and share == len(good) / 20
    made = {x.doc_id: x for x in quality_classifier.resampled(docs, labels).collect()}
    noise = {x.i: -np.log(-np.log(x.u)) for x in spark.range(82).select(F.col("id").alias("i"), quality_classifier.uniform(F.col("id"), seed=6).alias("u")).collect()}
    for i, t in enumerate(texts):
        total = want[quality_classifier.features(t)].sum()
        assert made[i].log_ratio == pytest.approx(total) and made[i].key == pytest.approx((total + noise[i]) * quality_classifier.SCALE, abs=3)
    least = sorted((x.key for x in made.values()), reverse=True)[round(82 * share) - 1]
    assert all(x.kept == (x.key >= least) for x in made.values())


def test_packing(spark, odd, none):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    made = packing.packed(clashing(odd), WORD_BPE, 2).toPandas()
    rows = odd.toPandas()
    ids = lambda t: np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
    want = Counter(zlib.crc32(ids(t).tobytes()) for t in rows.text)
    whole = made.sort_values(["doc_id", "start"])
    for i in (1, 2, 4, 6, 7, 9):
        own = whole[whole.doc_id == i]
        assert zlib.crc32(b"".join(own.ids)) in want and own.length.sum() == own.doc_tokens.iloc[0]
    assert made.length.sum() == sum(len(ids(t)) for t in rows.text)
    for _, x in made.sort_values("offset").groupby("sequence_id"):
        assert (x.offset.to_numpy() == np.concatenate([[0], x.length.cumsum()[:-1]])).all() and x.length.sum() <= 4096
    assert made.groupby("sequence_id").length.sum().sort_index()[:-1].eq(4096).all()
    assert packing.packed(none, WORD_BPE, 2).count() == 0


def round_robin(tokens, weights, window):
    """Deficit round-robin, walked window by window: how many tokens each queue gives. Where a queue ends, it gives all it has, the others fill up by weight."""
    left, out, deficit = list(tokens), [], [Fraction(0)] * len(tokens)
    while sum(left) > window:
        open_ = [j for j, x in enumerate(left) if x]
        share = sum(weights[j] for j in open_)
        deficit = [d + Fraction(weights[j] * window, share) if left[j] else Fraction(0) for j, d in enumerate(deficit)]
        row = [int(max(d, 0)) for d in deficit]
        if any(left[j] < deficit[j] for j in open_):
            row, rest = [0] * len(left), list(open_)
            while any(left[j] * sum(weights[i] for i in rest) <= (window - sum(row)) * weights[j] for j in rest):
                done = [j for j in rest if left[j] * sum(weights[i] for i in rest) <= (window - sum(row)) * weights[j]]
                for j in done:
                    row[j] = left[j]
                rest = [j for j in rest if j not in done]
            want = window - sum(row)
            for j in rest:
                row[j] = want * weights[j] // sum(weights[i] for i in rest)
            deficit = [Fraction(x) for x in row]
            deficit[max(rest, key=lambda j: left[j])] += window - sum(row)
            row[max(rest, key=lambda j: left[j])] += window - sum(row)
        for j in sorted(open_, key=lambda j: row[j] - deficit[j])[: window - sum(row)]:
            row[j] += 1
        deficit = [d - x for d, x in zip(deficit, row)]
        left = [x - y for x, y in zip(left, row)]
        out.append(row)
    return out + [left] if sum(left) else out


def given(phases):
    out = []
    for p in phases:
        before = packing.allotted(0, p.ends, p.per)
        for m in range(p.rounds):
            after = packing.allotted(m + 1, p.ends, p.per)
            out.append([b - a for a, b in zip(before, after)])
            before = after
    return out


@pytest.mark.parametrize("tokens, weights", [([700, 300, 5000], None), ([4000, 4000, 4000], [5, 2, 1]), ([10, 0, 9000, 3], [1, 1, 1, 1]), ([0, 0], [1, 1]), ([50], [2]), ([3000, 2999, 1, 700, 64, 1200, 900], [8, 1, 1, 3, 1, 2, 2])])
def test_schedule_is_a_deficit_round_robin(tokens, weights):
    weights = weights or [float(t) for t in tokens]
    made, want = given(packing.schedule(tokens, weights, 256)), round_robin(tokens, [int(w) for w in weights], 256)
    assert [sum(x) for x in zip(*made)] == [t for t in tokens] if made else not any(tokens)
    assert len(made) == len(want) and all(sum(x) == 256 for x in made[:-1]) and all(y >= 0 for x in made for y in x)
    # What each queue has sent differs from the walk by tokens for fractions, at each end anew.
    for a, b in zip(np.cumsum(made, 0) if made else [], np.cumsum(want, 0) if want else []):
        assert np.abs(a - b).max() <= 2 * len(tokens) + 2


def test_queue_places_every_token_once():
    r = random.Random(9)
    for _ in range(30):
        tokens = [r.choice([0, 1, 17, r.randrange(3000)]) for _ in range(r.randint(1, 6))]
        phases = packing.schedule(tokens, [r.randint(1, 9) for _ in tokens], 64)
        seen = Counter()
        for j, t in enumerate(tokens):
            n = []
            while sum(n) < t:
                n.append(min(t - sum(n), r.choice([1, 5, 300])))
            n = np.array(n, np.int64)
            if t:
                doc, start, length, seq, offset = packing.Queue(phases, j).pieces(np.cumsum(n) - n, n)
                assert (np.bincount(doc, length, len(n)) == n).all()
                for q, o, k in zip(seq, offset, length):
                    seen.update((int(q), x) for x in range(o, o + k))
        assert len(seen) == sum(tokens) and set(seen.values()) <= {1}
        assert set(seen) == {(q, x) for q in range(-(-sum(tokens) // 64)) for x in range(min(64, sum(tokens) - 64 * q))}


def test_packing_fills_windows_to_targets(spark):
    r = random.Random(10)
    rows = [(i, " ".join(r.choice(["red", "green", "blue"]) for _ in range(r.randint(1, 900))), "en", "a" if i % 4 == 0 else "b" if i % 4 < 3 else None, 0) for i in range(600)] + [(1000 + i, "few words", "en", f"tiny{i}", 0) for i in range(70)]
    docs = spark.createDataFrame(rows, DOCS).repartition(5)
    got = packing.packed(docs, WORD_BPE, 2).toPandas()
    total = got.length.sum()
    by = got.assign(source=got.source.where(~got.source.fillna("").str.startswith("tiny"), "tiny").fillna("~")).pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    share = by.sum() / total
    assert ((by[1:-2] - share * 4096).abs() <= 4).all().all()  # a token for fractions, and weights in parts of a window
    assert len(got) <= len(rows) + len(by) * by.shape[1]
    got = packing.packed(docs, WORD_BPE, 2, shares={"a": 3, "b": 1, None: 1}).toPandas()
    by = got.assign(source=got.source.where(~got.source.fillna("").str.startswith("tiny"), "tiny").fillna("~")).pivot_table(index="sequence_id", columns="source", values="length", aggfunc="sum", fill_value=0)
    early = by[: int((by["a"] > 0).sum()) - 2]
    assert (early["a"] > 2.9 * early["b"]).all() and (early["b"] - early["~"]).abs().max() <= 3 and len(early) > 5
    assert got.length.sum() == total and (got.groupby("sequence_id").length.sum().sort_index()[:-1] == 4096).all()


def test_chunks_encode_as_the_tokenizer_does():
    known, r = packing.Chunks(WORD_BPE), random.Random(1)
    parts = list("aZé'sß.,!?<|>0123 \n\t$#ÀÉÇñ’…—½²µª°“”ſİΣςﬁ①́　中文あ😀_-\x1c ") + ["'s", "'LL", "<|endoftext|>", "<|ENDOFTEXT|>", "don't", "THE!!", " "]
    texts = ["".join(r.choice(parts) for _ in range(r.randint(0, 30))) for _ in range(3000)]
    for i in range(0, 3000, 50):
        for t, got in zip(texts[i : i + 50], known.of(pa.array(texts[i : i + 50]))):
            assert np.frombuffer(got, "<u2").tolist() == known.tokenizer.encode(t, add_special_tokens=False).ids


def lcs(a, b):
    prev = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(prev[j] + 1 if x == y else max(prev[j + 1], row[j]))
        prev = row
    return prev[-1]


def test_alignment():
    r = random.Random(5)
    for _ in range(200):
        a = np.array([r.randrange(50) for _ in range(r.randint(1, 60))], np.uint32)
        b = list(a)
        for _ in range(r.randint(0, 3)):
            i = r.randrange(len(b) + 1)
            b[i : i + r.randint(0, 2)] = [r.randrange(50)] * r.randint(0, 2)
        b = np.array(b, np.uint32)
        x, y = near_dedup.shingles(a).tolist(), near_dedup.shingles(b).tolist()
        if x and y:
            common = lcs(x, y)
            want = common / (len(x) + len(y) - common)
            assert (near_dedup.similarity(a, b) >= 0.8) == (want >= 0.8)
            assert want < 0.8 or near_dedup.similarity(a, b) == pytest.approx(want)
    blocks = np.arange(200_000, dtype=np.uint32)
    assert len(near_dedup.sketch(blocks)) == near_dedup.SKETCHES


def test_near_dedup(spark, odd, none):
    r = random.Random(6)
    base = [words(r, 120, 3000) for _ in range(30)]
    rows = []
    for i, b in enumerate(base):
        for k in range(1 + i % 5):
            w = list(b)
            if k:
                w[r.randrange(120)] = f"new{i}{k}"
            rows.append(" ".join(w))
    common = " ".join(words(r, 60, 3000))
    rows += [common + " " + " ".join(words(r, 70, 3000)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "doc_id long, text string").repartition(4)
    got = {x.doc_id: x.class_id for x in near_dedup.grouped(docs).collect()}
    seqs = [near_dedup.shingles(near_dedup.word_hashes(t)).tolist() for t in rows]
    parent = list(range(len(rows)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(rows)):
        for j in range(i):
            if set(seqs[i]) & set(seqs[j]):
                c = lcs(seqs[i], seqs[j])
                if c / (len(seqs[i]) + len(seqs[j]) - c) >= 0.8:
                    a, b = sorted((find(i), find(j)))
                    parent[b] = a
    assert got == {i: find(i) for i in range(len(rows))}
    made = near_dedup.grouped(odd).collect()
    by = {x.doc_id: x for x in made if x.doc_id is not None}
    assert len(made) == odd.count() and by[6].class_id == by[7].class_id == 6 and by[7].class_size == 2 and not by[7].kept
    assert sum(x.kept for x in made) == len({x.class_id for x in made}) and by[4].class_id == by[5].class_id == by[8].class_id
    kept = near_dedup.deduplicated(clashing(odd))
    assert kept.columns == clashing(odd).columns and kept.count() == len({x.class_id for x in made})
    assert near_dedup.grouped(none).count() == 0 and near_dedup.deduplicated(none).count() == 0


def components_by_hand(texts, near):
    """Smallest index of the component of each text; ``near``: which pairs to align."""
    hashed = [near_dedup.word_hashes(t) for t in texts]
    parent = list(range(len(texts)))
    find = lambda x: x if parent[x] == x else find(parent[x])
    for i in range(len(texts)):
        for j in range(i):
            if near(i, j) and near_dedup.similarity(hashed[i], hashed[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(texts))]


def test_near_dedup_links_to_any_copy(spark):
    """Copies of copies: near to one text of a large group, not to its base."""
    r = random.Random(12)
    rows = []
    for g in range(3):
        base = words(r, 120, 3000)
        copies = []
        for k in range(150):
            w = list(base)
            for i in r.sample(range(120), 2):
                w[i] = f"c{g}_{k}_{i}"
            copies.append(w)
        rows += [base, *copies]
        for k in range(60):
            w = list(copies[r.randrange(150)])
            for i in (10, 60, 100)[: 2 + k % 2]:
                w[i + r.randrange(5)] = f"y{g}_{k}_{i}"
            rows.append(w)
    texts = [" ".join(w) for w in rows]
    keys = [set(near_dedup.sketch(near_dedup.word_hashes(t)).tolist()) for t in texts]
    want = components_by_hand(texts, lambda i, j: not keys[i].isdisjoint(keys[j]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {x.doc_id: x.class_id for x in near_dedup.grouped(docs).collect()} == dict(enumerate(want))


def test_near_dedup_of_chains_and_trees(spark):
    """Families in which a text is near to its parent only; some swap halves, some share a long passage, one has no text near to all."""
    r = random.Random(21)
    rows = []
    for g in range(12):
        base = words(r, 100 + 10 * g, 3000)
        members = [base]
        for k in range(79):
            parent = members[-1] if g % 3 == 0 else r.choice(members) if g % 3 == 1 else base
            w = list(parent)
            for i in r.sample(range(len(w)), 1 + k % 4):
                kind = r.randrange(3)
                w[i] = f"n{g}_{k}_{i}" if kind == 0 else w[i] + " " + f"i{g}_{k}" if kind == 1 else ""
            w = " ".join(w).split()
            if k % 13 == 5:
                w = w[len(w) // 2 :] + w[: len(w) // 2]
            members.append(w)
        rows += members[g % 2 * 1 :]  # of half of the families the first text is missing
    passage = words(r, 80, 3000)
    rows += [passage + words(r, 30 + k % 9, 3000) for k in range(60)]
    texts = [" ".join(w) for w in rows]
    assert len(texts) >= 900
    keys = [set(near_dedup.sketch(near_dedup.word_hashes(t)).tolist()) for t in texts]
    want = components_by_hand(texts, lambda i, j: not keys[i].isdisjoint(keys[j]))
    assert 70 < len(set(want)) < 600
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {x.doc_id: x.class_id for x in near_dedup.grouped(docs).collect()} == dict(enumerate(want))


def test_differences_from_a_base_lose_no_similar_pair():
    """Whatever the base: similar texts, one of them not near to the center, meet by one of their first items or as central ones."""
    r = random.Random(22)
    met, shorter = Counter(), 0
    for _ in range(300):
        center = words(r, 60, 500)

        def copy(w, least, most):
            w = list(w)
            for i in sorted(r.sample(range(len(w)), r.randint(least, most)), reverse=True):
                w[i : i + 1] = [[], [f"a{r.randrange(10**6)}"], [w[i], f"b{r.randrange(10**6)}"]][r.choice([0, 0, 1, 2])]
            return w

        stems = [copy(center, 1, 4) for _ in range(3)]
        family = [copy(r.choice(stems), 0, 2) for _ in range(12)]
        marks = [np.sort(near_dedup.labelled(near_dedup.shingles(near_dedup.word_hashes(" ".join(w))))) for w in [center, *family]]
        fix = np.sort(np.array(r.sample(marks[1].tolist(), r.choice([0, 0, 4])) + r.sample(marks[0].tolist(), r.choice([0, 3])), np.uint64))
        fix = np.unique(fix)
        said = [near_dedup.against_base(m, marks[0], fix) for m in marks[1:]]
        often = Counter(i for x in said for i in x[5].tolist())
        first = [sorted(x[5].tolist(), key=lambda i: (often[i], i)) for x in said]
        for i, j in itertools.permutations(range(12), 2):
            x, y, a, b = said[i], said[j], marks[1 + i], marks[1 + j]
            common = len(np.intersect1d(a, b))
            if (x[0] and y[0]) or x[2] > y[2] or common < 0.8 * (len(a) + len(b) - common):
                continue
            ways = (bool(set(first[i][: x[3]]) & set(first[j][: y[4]])), any(not u[0] and v[2] <= 10 / 8 * len(fix) + 1e-6 and x[2] + y[2] <= (x[1] + y[1]) / 9 + 1e-6 for u, v in ((x, y), (y, x))))
            assert any(ways)
            met[ways] += 1
            shorter += x[3] < x[2]
    assert sum(met.values()) > 200 and shorter > 50


def test_near_dedup_of_short_texts(spark):
    r = random.Random(13)
    line = words(r, 12, 3000)
    rows = []
    for k in range(250):
        w = words(r, r.randint(8, 40), 3000)
        if k % 5 == 0:
            w += line  # a line that many texts have
        other = list(w)
        if k % 3 == 0:
            other.append(f"new{k}")
        elif k % 3 == 1:
            other = other[1:]
        else:
            other[-1 - r.randrange(2)] = f"new{k}"
        rows += [w, other]
    texts = [" ".join(w) for w in rows]
    runs = [set(near_dedup.shingles(near_dedup.word_hashes(t)).tolist()) for t in texts]
    want = components_by_hand(texts, lambda i, j: not runs[i].isdisjoint(runs[j]))
    assert len(set(want)) < 450
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    assert {x.doc_id: x.class_id for x in near_dedup.grouped(docs).collect()} == dict(enumerate(want))


def test_lm_scoring(spark, odd, none):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    made = lm_scoring.scored(docs, labels.where("doc_id % 2 = 0")).join(labels.where("doc_id % 2 = 1"), "doc_id").toPandas().dropna()
    good, bad = made[made.quality == 1].score, made[made.quality == 0].score
    assert np.mean([(g < bad).mean() for g in good]) >= 0.95
    got = {x.doc_id: x for x in lm_scoring.scored(clashing(odd), labels).collect()}
    assert got[4].n_tokens == 0 and got[4].score is None and got[6].n_tokens == 20_000
    assert lm_scoring.scored(none, labels).count() == 0


def test_lm_target_is_fitted_on_every_good_document(spark):
    """More labels than a sample would hold: each text is one word of its own, so all that were counted lose alike."""
    docs = spark.range(0, 21_000, 1, 4).selectExpr("id AS doc_id", "concat('w', id) AS text")
    labels = docs.selectExpr("doc_id", "IF(doc_id < 20900, 1, 0) AS quality")
    got = lm_scoring.scored(docs, labels).collect()
    good = {round(x.target_loss, 9) for x in got if x.doc_id < 20_900}
    assert len(got) == 21_000 and len(good) == 1 and good.pop() < min(x.target_loss for x in got if x.doc_id >= 20_900)


def test_lm_scores_by_brute_force(spark, monkeypatch):
    """Against plain counting, over many blocks and shards; repeated rows count and score each on their own."""
    monkeypatch.setattr(lm_scoring, "BLOCK", 300)
    monkeypatch.setattr(lm_scoring, "SHARD", 100)
    r = random.Random(31)
    texts = [" ".join(words(r, r.randint(0, 40), 30)) for _ in range(150)] + ["Don't stop, w1 w2!", None, "w1", "w1", "  "]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + [(3, texts[3], "en", "s", 0), (None, texts[4], "en", "s", 0)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), 0) for i in range(0, 150, 2)], "doc_id long, quality int, toxic int")
    got = lm_scoring.scored(spark.createDataFrame(rows, DOCS).repartition(3), labels).collect()
    assert len(got) == len(rows)
    split = lambda t: re.findall(r"\w+|[^\w\s]+", (t or "").lower())
    counts = [Counter(), Counter()]
    for i, t, *_ in rows:
        w = split(t)
        w = [*w, "END"] if w else []
        for good in {0, int(i is not None and i < 150 and i % 6 == 0)}:
            counts[good].update(tuple(w[j - k : j + 1]) for k in range(lm_scoring.ORDER) for j in range(k, len(w)))
    vocabulary = sum(len(k) == 1 for k in counts[0])

    def loss(w, c):
        events = sum(n for k, n in c.items() if len(k) == 1)
        out = []
        for j in range(len(w)):
            p = (c[(w[j],)] + 1) / (events + vocabulary + 1)
            for k in range(1, min(j, lm_scoring.ORDER - 1) + 1):
                p = (c[tuple(w[j - k : j + 1])] + lm_scoring.PRIOR * p) / (c[tuple(w[j - k : j])] + lm_scoring.PRIOR)
            out.append(-np.log(p))
        return np.mean(out)

    by = defaultdict(list)
    for x in got:
        by[x.doc_id].append(x)
    assert len(by[3]) == 2 and by[3][0].score == by[3][1].score
    for i, t, *_ in rows:
        x, w = by[i][0], split(t)
        assert x.n_tokens == len(w)
        if not w:
            assert x.score is None and x.target_loss is None
            continue
        background, target = loss(w, counts[0]), loss(w, counts[1])
        assert x.background_loss == pytest.approx(background) and x.target_loss == pytest.approx(target) and x.score == pytest.approx(target - background)


def test_lm_counts_are_whole_numbers_of_any_size():
    """A run that occurs 2^40 times in each of two blocks."""
    keys = np.array([5, 1, 7], np.uint64)  # the second block asks for two words, one of which the first has as well
    rows = pa.table({"shard": pa.array([0, 0], pa.int32()), "block": pa.array([7, 5]), "n": pa.array([2, 2], pa.int32()), "singles": pa.array([1, 1], pa.int32()), "keys": [lm_scoring.steps(keys[:2], 1), lm_scoring.steps(keys[1:], 1)], "all_": [lm_scoring.packed(np.array([4, 1 << 40])), lm_scoring.packed(np.array([1 << 40, 9]))], "good": [lm_scoring.packed(np.zeros(2, np.int64))] * 2})
    assert lm_scoring.keys_of(lm_scoring.steps(keys[:2], 1), 2, 1).tolist() == [5, 1]
    said = {x["block"]: x for x in lm_scoring.answer(rows).to_pylist()}
    assert lm_scoring.unpacked(said[7]["all_"], 2, "<i8").tolist() == [4, 1 << 41] and lm_scoring.unpacked(said[5]["all_"], 2, "<i8").tolist() == [1 << 41, 9]
    assert (said[5]["fresh"], said[7]["fresh"]) == (1, 1)


def test_lm_estimates_sum_to_one():
    r = random.Random(32)
    w = [r.choice("abc") for _ in range(200)] + ["END"]
    counts = Counter(tuple(w[j - k : j + 1]) for k in range(3) for j in range(k, len(w)))
    for context in [("a",), ("b", "c"), ("a", "a")]:
        total = 0.0
        for x in [*"abc", "END", "unseen"]:
            p = (counts[(x,)] + 1) / (len(w) + 4 + 1)
            for k in range(1, len(context) + 1):
                p = (counts[(*context[-k:], x)] + lm_scoring.PRIOR * p) / (counts[context[-k:]] + lm_scoring.PRIOR)
            total += p
        assert total == pytest.approx(1)


def test_warc(spark, tmp_path):
    rows = [(1, "http://a/x y\r\nEvil: 1", "<p>\r\n\r\nWARC/1.1"), (2, None, "<p>\r\n\r\nWARC/1.1"), (5, "u", "<p>\r\n\r\nWARC/1.1"), (3, "u", None), (4, "u", ""), (None, "u", "z"), (6, "u", "é中" * 40_000), (7, "u", "alone"), (8, "u", "again"), (8, "u", "again"), (9, "v", "again"), (None, "u", "nobody"), (None, "u", "nobody")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    want = {1: ("revisit", 5), 2: ("revisit", 5), 5: ("response", None), 3: ("revisit", 4), 4: ("response", None), 6: ("response", None), 7: ("response", None), 8: ("revisit", 9), 9: ("response", None)}
    for most in (warc.BROADCAST_ROWS, 0):  # a broadcast table, and the bit map
        all_ = warc.archived(clashing(pages), broadcast_rows=most).collect()
        got = {x.page_id: x for x in all_}
        assert len(all_) == len(rows) and all(x.record_type == "response" for x in all_ if x.page_id is None)
        for i, _, html in rows:
            payload = (html or "").encode()
            if i is not None:
                assert got[i].payload_bytes == len(payload) and got[i].payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        assert {i: (x.record_type, x.refers_to) for i, x in got.items() if i is not None} == want
        assert bytes(got[6].payload) == ("é中" * 40_000).encode() and got[1].payload is None
    assert all(x.record_type == "response" for x in warc.archived(pages.where("page_id != 6"), min_bytes=100).collect())
    assert warc.archived(pages.limit(0)).count() == 0


def test_warc_repeated_rows_are_responses(spark):
    pages = spark.createDataFrame([(8, "u", "again"), (8, "u", "again")], "page_id long, url string, html string")
    assert [x.record_type for x in warc.archived(pages).collect()] == ["response", "response"]


def test_warc_files_are_whole_gzip_files(spark, tmp_path, monkeypatch):
    """Any gzip reader reads them, each record is a member of its own, and files have a bounded number of bytes."""
    monkeypatch.setattr(warc, "CHUNK_BYTES", 20_000)
    monkeypatch.setattr(warc, "CHUNKS_A_FILE", 2)
    r = random.Random(3)
    rows = [(i, f"http://h/{i}", "".join(chr(r.randrange(33, 126)) for _ in range(3000 + 20_000 * (i % 50 == 0)))) for i in range(200)]
    rows += [(500 + i, "http://c/", rows[7][2]) for i in range(20)]
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), str(tmp_path / "w"))
    files = sorted((tmp_path / "w").glob("part-*"))
    assert len(files) > 4 and all(f.stat().st_size < 100_000 for f in files)
    types = Counter()
    for f in files:
        with gzip.open(f) as g:
            whole = g.read()
        assert whole == b"".join(warc.members(f.read_bytes()))
        assert warc.parse(next(warc.members(f.read_bytes()))) is None  # a warcinfo leads
        types.update(re.findall(rb"(?m)^WARC-Type: (\w+)\r$", whole))
    assert types[b"response"] == 200 and types[b"revisit"] == 20
    text = b"".join(b"".join(warc.members(f.read_bytes())) for f in files).decode("latin-1")
    ids = set(re.findall(r"WARC-Record-ID: (\S+)", text))
    assert set(re.findall(r"WARC-Refers-To: (\S+)", text)) <= ids and len(set(re.findall(r"WARC-Refers-To-Target-URI: (\S+)", text))) == 1
    assert len(warc.member(b"x" * (1 << 24))) and b"".join(warc.members(warc.member(b"x" * (1 << 24)) + warc.member(b"y"))) == b"x" * (1 << 24) + b"y"


def test_warc_shuffles_headers_only(spark):
    pages = spark.createDataFrame([(1, "u", "x"), (2, "u", "x")], "page_id long, url string, html string")
    rows = warc.with_digests(pages)
    plan = warc.with_kinds(rows, warc.resolve_revisits(rows.drop("_html")))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and all("_html" not in line for line in plan.splitlines() if "Exchange" in line)


def test_pipeline(spark):
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "exact dedup", "minhash near-dedup", "mixing", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, d)
        assert out.columns == docs.columns and 0 < out.count()
        if name in ("exact dedup", "minhash near-dedup"):
            want = exact_dedup.groups(docs).where("kept") if name == "exact dedup" else near_dedup.grouped(docs).where("kept")
            assert {x.doc_id for x in out.collect()} == {x.doc_id for x in want.collect()}
        docs = out
    texts = {}
    for x in corpus_pipeline.run(spark, d).orderBy("doc_id", "start").collect():
        texts.setdefault(x.doc_id, []).append((x.start, bytes(x.ids)))
    # The last stage packs just what the stages before it left, as often as the mix takes it.
    copies = Counter(x.doc_id for x in docs.collect())
    assert {k: sum(s == 0 for s, _ in v) for k, v in texts.items()} == dict(copies)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    for x in docs.dropDuplicates(["doc_id"]).collect():
        ids = np.array([*tokenizer.encode(x.text or "", add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert sum(len(b) for _, b in texts[x.doc_id]) == len(ids) * copies[x.doc_id]


def test_pipeline_stages_with_odd_rows(spark, odd, none):
    """Nulls, empty and long texts, repeated rows, other columns with clashing names, empty tables: as each stage's docstring says."""
    import corpus_pipeline

    d = "/root/testdata/sf0.001"
    for name, stage in corpus_pipeline.STAGES:
        assert stage.__doc__
        made = stage(spark, clashing(odd), d)
        n = made.count()
        assert stage(spark, none, d).count() == 0
        if name != "packing":
            assert made.columns == clashing(odd).columns
        assert n <= 2 * odd.count() if name != "packing" else made.agg(F.sum("length")).first()[0] > 40_000
