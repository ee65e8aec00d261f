"""The as-of join, token counts and spelling groups against plain restatements."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from brute import FOLD, ODD
from hypothesis import given, settings
from hypothesis import strategies as st

from quillspark.llm import asof, counts, spelling

FILE = f"{counts.FOLDER}/byte_bpe_50k.json"
HOUR = 3_600_000_000


# ---------------------------------------------------------------- as-of join


def as_of_brute(left, right, tolerance):
    """id: (key, t, lag, n_tied, data), one left row at a time."""
    copies = {}
    for i, key, t in left:
        if i is not None:
            order = (t is None, t or 0, key is None, key or 0)
            if i not in copies or order < copies[i][0]:
                copies[i] = (order, key, t)
    out = {}
    for i, (_, key, t) in copies.items():
        met = [r for r in right if key is not None and t is not None and r[0] == key and r[1] is not None and t - tolerance <= r[1] <= t]
        if met:
            last = max(r[1] for r in met)
            tied = sorted((r for r in met if r[1] == last), key=lambda r: r[2:])
            out[i] = (key, t, t - last, len(tied), tied[0][3])
        else:
            out[i] = (key, t, None, 0, None)
    return out


def as_of_rows(spark, left, right, tolerance, rows):
    a = spark.createDataFrame(left, "id long, key long, t long")
    b = spark.createDataFrame(right, "key long, t long, tie int, data int")
    return {r.id: (r.key, r.t, r.lag, r.n_tied, r.data) for r in asof.as_of(a, b, tolerance, rows).collect()}


@pytest.mark.parametrize("rows", [1, 4, 128])
def test_as_of_equals_brute_force_however_finely_buckets_are_cut(spark, rows):
    r = random.Random(rows)
    key = lambda: r.choice([None, 1, 1, 1, 2, 3, -4])
    left = [(i, key(), r.choice([None, *[r.randrange(-3000, 3000) for _ in range(20)]])) for i in range(400)]
    left += [(r.randrange(400), 1, r.randrange(3000)) for _ in range(30)] + [(None, 1, 5)]  # copies that differ, a null id
    right = [(key(), r.choice([None, *[r.randrange(-3500, 3000) for _ in range(20)]]), r.randrange(4), k) for k in range(300)]
    right += [(1, 77, k % 5, 1000 + k) for k in range(40)]  # many ties
    assert as_of_rows(spark, left, right, 100, rows) == as_of_brute(left, right, 100)


def test_as_of_over_groups_of_slices(spark, monkeypatch):
    monkeypatch.setattr(asof, "FAN", 2)  # four slices a group
    r = random.Random(3)
    left = [(i, 1, r.randrange(4000)) for i in range(500)]
    right = [(1, r.choice([r.randrange(4000), r.randrange(40)]), 0, k) for k in range(200)]
    assert as_of_rows(spark, left, right, 1000, 1) == as_of_brute(left, right, 1000)


def test_the_tolerance_is_inclusive_and_future_rows_never_match(spark):
    left = [(1, 1, 100), (2, 1, 200), (3, 1, 201), (4, 1, 99), (5, 2, 100)]
    got = as_of_rows(spark, left, [(1, 100, 0, 7)], 100, 128)
    assert {i: v[2] for i, v in got.items()} == {1: 0, 2: 100, 3: None, 4: None, 5: None}


def test_as_of_of_empty_tables(spark):
    assert as_of_rows(spark, [], [(1, 1, 1, 1)], 10, 4) == {}
    assert as_of_rows(spark, [(1, 1, 1)], [], 10, 4) == {1: (1, 1, None, 0, None)}


def test_a_hot_instant_gives_no_pairs(spark):
    left = [(i, 1, 5_000) for i in range(3000)]
    right = [(1, 5_000, k, k) for k in range(3000)]
    got = as_of_rows(spark, left, right, 100, 16)
    assert set(got.values()) == {(1, 5_000, 0, 3000, 0)}


def test_clicks_to_orders(spark):
    crc = lambda i: zlib.crc32(str(i).encode())
    micros = lambda text: spark.sql(f"SELECT timestamp_ntz '{text}' AS ts").select(asof.micros("ts")).first()[0]
    assert micros("1970-01-02 00:00:00.000001") == 86_400_000_001 and micros("1969-12-31 23:59:59.5") == -500_000
    clicks = spark.createDataFrame([(i, f"2024-03-31 0{i % 4}:{10 + i}:00.25", 1, "x") for i in range(9)], "click_id long, ts string, client_id long, m string").withColumn("ts", asof.F.col("ts").cast("timestamp_ntz"))
    sales = spark.createDataFrame([(i, f"2024-03-31 00:{30 + i}:00", 1, i % 5 or None, 1.005 * i, "open") for i in range(20)], "sale_id long, sold_at string, client_id long, priority int, total double, status string").withColumn("sold_at", asof.F.col("sold_at").cast("timestamp_ntz"))
    coarse = lambda i, t: t - t % HOUR if crc(i) % 2 else t
    orders = []
    for s in sales.collect():
        t, cents = coarse(s.sale_id, micros(s.sold_at)), int((100 * s.total + 0.5) // 1)
        both = [(s.sale_id, s.priority)] + ([(-1 - s.sale_id, s.priority and 6 - s.priority)] if crc(s.sale_id) % 3 else [])
        orders += [(t, (p is None, p or 0, -i), i, cents) for i, p in both]
    for r in asof.clicks_to_orders(clicks, sales).collect():
        t = coarse(r.click_id, micros(clicks.where(f"click_id = {r.click_id}").first().ts))
        met = [o for o in orders if o[0] <= t <= o[0] + 240 * HOUR]
        tied = sorted(o for o in met if o[0] == max(x[0] for x in met))
        want = (tied[0][2], t - tied[0][0], tied[0][3], len(tied)) if tied else (None, None, None, 0)
        assert (r.ts_us, r.sale_id, r.lag_us, r.total_cents, r.n_tied) == (t, *want)


# ---------------------------------------------------------------- token counts


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(FILE)


@pytest.fixture(scope="module")
def counter():
    with open(FILE) as f:
        data = f.read()
    return counts.Counter(data, counts.whole_tokens(data))


def length(tokenizer, text):
    return len(tokenizer.encode(text, add_special_tokens=False).ids)


def test_kept_strings_are_one_token_wherever_they_are_a_pre_token(tokenizer, counter):
    assert len(counter) > 45_000
    assert all(length(tokenizer, s) == 1 for s in random.Random(1).sample(list(counter), 3000))


def test_classes_of_certain_characters_are_those_of_the_tokenizer(tokenizer):
    pre = tokenizer.pre_tokenizer
    certain = [chr(c) for c in range(0xFFFF) if not 0xD800 <= c < 0xE000 and not counts._UNCERTAIN.search(chr(c))]
    assert len(certain) > 1400
    for c in certain:
        text = f"a{c}a1{c}1!{c}!  {c}"
        assert [x[1] for x in pre.pre_tokenize_str(text)] == [m.span() for m in counts._PRE.finditer(text)], hex(ord(c))
    for c in (chr(c) for c in range(0x10000) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or c in (0x180E, 0x200B, 0x2060, 0xFEFF))):
        assert (len(pre.pre_tokenize_str(f"!{c}")) == 2) == bool(re.fullmatch(f"[{counts.BLANK}]", c)), hex(ord(c))


ALPHABET = "aAbét \t\n\r.,'!19  ́ 😀\x1c中กſẞ<|>"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*ALPHABET, "<|endoftext|>", " the", "'ll", "don't", "  \n ", "naïve", "ǅ", "½", "٣", "🇩🇪"]), max_size=40).map("".join))
def test_counts_are_those_of_the_library(tokenizer, counter, text):
    assert counter.of(text) == length(tokenizer, text)


def test_pieces_do_not_change_counts(tokenizer, counter, monkeypatch):
    text = " ".join(random.Random(5).choice(["word", "x\n\n", "né!", "12,3", " ", "<|endoftext|>", "中文字"]) for _ in range(3000))
    monkeypatch.setattr(counts, "PIECE", 7)
    assert counter.of(text) == length(tokenizer, text)
    assert counter.of("ab1" * 5000) == length(tokenizer, "ab1" * 5000)


def test_what_is_one_token_is_not_merged_and_the_memory_is_bounded(counter, monkeypatch):
    before = counter.merged
    assert counter.of("the cat sat on the mat") == 6 and counter.merged == before
    monkeypatch.setattr(counts, "REMEMBERED", len(counter) + 5)
    for k in range(50):
        counter.of(f"zzqx{k}w")
    assert len(counter) <= counts.REMEMBERED + 1 and counter.of("the cat") == 2


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counted_rows_are_the_librarys(spark, name):
    file = f"{counts.FOLDER}/{name}"
    rows = [*ODD, (12, "repeated id"), (None, "no id <|endoftext|> here"), (77, "word " * 1024), (78, "word" + " word" * 1024)]
    if name.endswith("model"):
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=file)
        count = lambda text: len(p.encode(text))
    else:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(file)
        count = lambda text: len(t.encode(text, add_special_tokens=False).ids)
    got = counts.counted(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, n_tokens int"), file)
    want = Counter((i, len((t or "").encode()), count(t or ""), count(t or "") > 1024) for i, t in rows)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_bytes", "n_tokens", "over_limit").collect()) == want
    assert counts.counted(spark.createDataFrame([], "doc_id long, text string"), file).count() == 0


# ---------------------------------------------------------------- spelling groups


def spelling_brute(rows):
    """word: (n, n_near, form, form_n, root)."""
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = run.translate(FOLD)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 97 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            n[low] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    form, out = {}, {}
    for w in n:
        met = [x for x in n if x != w and near(w, x)]
        best = min(met, key=lambda x: (-n[x], x), default=None)
        form[w] = best if met and n[best] >= 2 * n[w] else None
        out[w] = [n[w], len(met), form[w], n.get(form[w])]
    for w in n:
        at = w
        while form[at]:
            at = form[at]
        out[w].append(at)
    return {w: tuple(v) for w, v in out.items()}


def groups(spark, rows):
    out = spelling.grouped(spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, word string"))
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in out.collect()}


def test_spelling_groups_equal_brute_force(spark):
    r = random.Random(11)
    stems = ["abcde", "aabbb", "ábcdé", "aaaaa", "banana", "Straße", "étéçà"]

    def variant():
        w = list(r.choice(stems))
        for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
            k = r.randrange(len(w))
            r.choice([lambda: w.pop(k), lambda: w.insert(k, r.choice("abcé")), lambda: w.__setitem__(k, r.choice("abcdé"))])()
        return "".join(w)

    rows = [(i, " ".join(variant() for _ in range(120)) + "\nÜbung×x fünf5zehn") for i in range(40)]
    rows += [*ODD, (None, "abcde " * 4), (None, "abcde " * 4), (3, "x" * 4000 + " " + "y" * 4000 + "z"), *[(100 + k, "q" * 3000 + "w " + "q" * 3001 + " ") for k in range(4)]]
    got = groups(spark, rows)
    assert got == spelling_brute(rows)
    assert any(v[2] and v[2] != v[4] for v in got.values())  # some chain is longer than one form


def test_chains_lead_to_the_last_form(spark):
    words = [("aaaaaaa", 3), ("aaaaaab", 6), ("aaaaabb", 12), ("aaaabbb", 24), ("aaabbbb", 48), ("aabbbbb", 96)]
    rows = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(words)]
    rows = [(i + 1000, t) for i, t in rows]
    got = groups(spark, rows)
    assert got == spelling_brute(rows) and got["aaaaaaa"][4] == "aabbbbb"


def test_no_words(spark):
    assert groups(spark, []) == {} and groups(spark, [(1, None), (2, ""), (3, "ab cd 1234")]) == {}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="abÀé", min_size=1, max_size=6), min_size=1, max_size=8, unique=True))
def test_keys_meet_exactly_once_for_words_at_distance_one(words):
    word, key, low, high = (x.tolist() for x in spelling.deletion_keys(pa.array(words)))
    rows = list(zip(word, key, low, high, strict=True))
    met = Counter()
    for a in rows:
        for b in rows:
            if a[0] < b[0] and a[1] == b[1]:
                both = a[2] >= 0 and b[2] >= 0 and a[2] <= b[3] and b[2] <= a[3]
                met[a[0], b[0]] += both or (a[2] < 0) != (b[2] < 0)

    def distance_one(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            assert met[i, j] == distance_one(words[i], words[j]), (words[i], words[j])


# ---------------------------------------------------------------- blocks of near-duplicate buckets


@pytest.mark.parametrize("sizes", [(399, 1), (200,), (60, 60), (50, 30, 20), (1, 1)])
def test_a_buckets_groups_hold_every_pair_of_labels_once(spark, monkeypatch, sizes):
    from quillspark.llm import near

    monkeypatch.setattr(near, "BLOCK", 8)
    rows = [(0, 7, 7919 * sum(sizes[:c]) + 7919 * k, 10, c, [0]) for c, n in enumerate(sizes) for k in range(n)]
    held = spark.createDataFrame(rows, "band int, hash long, id long, size int, class_id long, marks array<long>")
    groups = {}
    for r in near.grouped_rows(held).collect():
        groups.setdefault((r.one, r.two), []).append(r)
    met = Counter()
    for g in groups.values():
        two = len({r.side for r in g}) > 1
        met.update((a.id, b.id) for a in g for b in g if a.id < b.id and a.class_id != b.class_id and (not two or a.side != b.side))
    assert set(met) == {(min(a[2], b[2]), max(a[2], b[2])) for a in rows for b in rows if a[4] != b[4]} and all(n == 1 for n in met.values())
    if sizes == (399, 1):  # one outlier meets each block of the others once
        assert sum(map(len, groups.values())) == 399 + 1 + 50


def test_near_reads_long_texts_whole_and_leaves_other_columns(spark):
    from quillspark.llm import near

    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, long, "a", 9), (2, long + " end", "b", 8), (3, long[: len(long) // 2], "c", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id string, class_id int")
    assert sorted((r.doc_id, r.id, r.class_id) for r in near.filtered(docs).collect()) == [(1, "a", 9), (3, "c", 7)]


# ---------------------------------------------------------------- the language model's learners


def test_scores_do_not_depend_on_the_partitions(spark, sf_dir):
    from quillspark.llm import lm

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(120)
    held = [{r.doc_id: (r.score, r.base_score, r.n_known) for r in lm.scored(docs.repartition(n)).collect()} for n in (1, 5)]
    assert held[0].keys() == held[1].keys() and all(v[1:] == held[1][i][1:] and v[0] == pytest.approx(held[1][i][0], rel=1e-6) for i, v in held[0].items())


def test_learners_are_dealt_and_averaged_alike_however_windows_arrive(spark):
    import numpy as np

    from quillspark.llm import lm

    rng = np.random.default_rng(3)
    rows = [(k % 2, int(h), rng.integers(0, 30, 3 * lm.STRIDE).astype(np.int32).tobytes()) for k, h in enumerate(rng.integers(-(1 << 62), 1 << 62, 600))]
    table = spark.createDataFrame(rows, "round int, key long, windows binary")
    counts = np.arange(30.0) + 1
    one, done = lm.trained(table.coalesce(1), counts, rounds=2, each=64)
    two, _ = lm.trained(table.repartition(7), counts, rounds=2, each=64)
    assert all((one.weights[n] == two.weights[n]).all() for n in one.weights) and sum(n for n, _ in done) == 600


def test_all_windows_of_all_training_texts_are_learned_from(spark, sf_dir, monkeypatch):
    import numpy as np

    from quillspark.llm import lm

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").limit(60)
    done, trained = [], lm.trained
    monkeypatch.setattr(lm, "trained", lambda *a, **b: done.append(trained(*a, **b)) or done[-1])
    lm.scored(docs)
    with open(lm.TOKENIZER, "rb") as f:
        t = lm.tokenizer_of(f.read())
    texts = [r.text or "" for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 1]
    ids = [sum(len(t.encode(w.encode())) for w in re.findall(r"[^\x20\x09-\x0D]+", x)) + 1 for x in texts]
    assert sum(n for n, _ in done[0][1]) == sum(-(-n // lm.STRIDE) for n in ids)
    # a piece holds what its windows say
    rng = np.random.default_rng(5)
    at = np.concatenate(([0], np.cumsum(rng.integers(1, 900, 40))))
    ids = rng.integers(0, 70, at[-1])
    inputs, valid, target, _ = lm.windowed(ids, at, 70)
    want = np.concatenate((np.where(valid, inputs, -1), np.where(target >= 0, ids[np.maximum(target, 0)], -1)), axis=1)
    assert (lm.training_windows(70, ids, at, np.arange(40, dtype=np.uint64), 1)[0] == want).all()


# ---------------------------------------------------------------- personal data that the base patterns miss


def planted_spans(n):
    """Texts with one span each, and (kind or None, start, end): every fourth kind of row is clean."""
    r = random.Random(8)
    prose = lambda k: " ".join(r.choice("abcdefgh") + r.choice("aeiou") + r.choice("lmnrst") for _ in range(k))

    def card(good):
        d = "4" + "".join(r.choice("0123456789") for _ in range(14))
        check = -sum(sum(divmod(2 * int(c), 10)) if i % 2 == 0 else int(c) for i, c in enumerate(d[::-1])) % 10
        d += str(check if good else (check + 1 + r.randrange(8)) % 10)
        return " ".join(d[i : i + 4] for i in range(0, 16, 4))

    number = lambda: (r.randrange(200, 999), r.randrange(200, 999), r.randrange(1000, 9999))
    made = [
        lambda i: ("email", "write to ", f"user{i}@host{i % 9}.com"), lambda i: ("ip", "server ip ", f"10.{i % 200}.3.{i % 250}"), lambda i: ("card", "my card number is ", card(True)), lambda i: ("phone", "please call ", "+1 {} {} {}".format(*number())),
        lambda i: ("email", "mail me at ", f"user{i} (at) host{i % 9} (dot) com"), lambda i: ("ip", "from address ", f"2001:0db8:85a3:0000:0000:8a2e:0370:{i:04x}"), lambda i: ("card", "card number ", card(False)), lambda i: ("phone", "or call ", "({}) {}-{}".format(*number())),
        lambda i: (None, "order id ", card(False)), lambda i: (None, "version ", "300.400.1.2"), lambda i: (None, "took ", "12-34-56"), lambda i: (None, "part ", "+12 3"),
    ]
    out = []
    for i in range(n):
        kind, before, span = made[i % len(made)](i)
        head = f"{prose(8)} {before}"
        out.append((i, f"{head}{span} {prose(5)}", kind, len(head), len(head) + len(span)))
    return out


def test_planted_spans_of_every_kind_are_found_and_clean_texts_stay(spark):
    from quillspark.llm import pii

    rows = planted_spans(360)
    out = {r.doc_id: (r.spans or "").split(",") for r in pii.digest(spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")).collect()}
    found, missed, wrong = Counter(), Counter(), 0
    for i, _, kind, start, end in rows:
        if kind is None:
            wrong += out[i] != [""]
        else:
            (found if f"{kind}:{start}:{end}" in out[i] else missed)[kind] += 1
    assert all(found[k] >= 0.95 * (found[k] + missed[k]) for k in ("email", "ip", "card", "phone")) and wrong == 0, (found, missed, wrong)


def test_patterns_that_are_learned_from_are_bounded(spark):
    from quillspark.llm import pii

    found = pii.candidates(spark.createDataFrame([x[:2] for x in planted_spans(360)], "doc_id long, text string"))
    whole, few = pii.patterns_of(found).collect(), pii.patterns_of(found, most=5).collect()
    assert sum(r.n for r in whole) == sum(r.n for r in few) and len(few) < len(whole)
    rare = [r for r in few if r.n <= sorted(x.n for x in whole)[-5]]
    assert all(r.word == 0 and r["shape"] == 0 for r in rare)
    assert pii.classifier(found, most=5) is not None


# ---------------------------------------------------------------- FTRL-proximal against one text at a time


def test_ftrl_equals_a_plain_restatement():
    import math

    import numpy as np

    from quillspark.llm import tokens, toxicity

    bits, mask = 12, (1 << 64) - 1
    r = random.Random(12)
    vocabulary = ["vile", "Scum", "hateful", "nice", "garden", "thank", "you", "üüab", "x1", "a", "longerwordhere"]
    texts = [" ".join(r.choice(vocabulary) for _ in range(r.randrange(14))) + r.choice(["", "!", "\n"]) for _ in range(120)]
    labels = [float("vile" in t or "Scum" in t) for t in texts]

    def one(data, salt=0):  # the hash of one word, or of its head, by itself
        b = next(tokens.batches(pa.array([data])))[1]
        starts, ends, _ = b.words(tokens.ALNUM)
        return int(b.hashes(starts, ends, fold=True)[0]) ^ salt

    def place(h):
        return int(tokens.mix(np.array([h & mask], np.uint64))[0]) >> (64 - bits)

    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(FOLD))
        out = [one(w) for w in words]
        for gap, salt in ((1, 0x8CB92BA72F3D8DD7), (2, 0xD2B74407B1CE6E93)):
            out += [one(a) * salt + one(b) for a, b in zip(words, words[gap:], strict=False)]
        for size in toxicity.HEADS:
            out += [one(w.encode()[:size].decode("utf-8"), size) for w in words if len(w.encode()) > size]
        return {k: min(n, toxicity.MOST) for k, n in Counter(map(place, out)).items()}

    held = [features(t) for t in texts]
    alpha, beta, l1 = 0.3, 1.0, 0.5
    z, n = {}, {}

    def weight(k):
        penalty = 0 if k == "bias" else l1
        v = z.get(k, 0.0)
        return 0.0 if abs(v) <= penalty else -(v - math.copysign(penalty, v)) / ((beta + math.sqrt(n.get(k, 0.0))) / alpha)

    for epoch in range(3):
        for i in np.random.default_rng(epoch).permutation(len(texts)):
            x = held[i] | {"bias": 1}
            w = {k: weight(k) for k in x}
            p = 1 / (1 + math.exp(-sum(w[k] * v for k, v in x.items())))
            for k, v in x.items():
                g = (p - labels[i]) * v
                old = n.get(k, 0.0)
                n[k] = old + g * g
                z[k] = z.get(k, 0.0) + g - (math.sqrt(n[k]) - math.sqrt(old)) / alpha * w[k]
    want = {k: weight(k) for k in z}

    rows = toxicity.training_rows(pa.array(texts), bits)
    model = toxicity.learn([np.array(x, np.int32) for x in rows.to_pylist()], np.array(labels), bits, alpha=alpha, beta=beta, l1=l1)
    got = dict(zip(model.at.tolist(), model.weights.tolist(), strict=True))
    assert set(got) <= set(z) and all(got.get(k, 0) == pytest.approx(v, rel=1e-4, abs=1e-6) for k, v in want.items() if k != "bias")  # one may be 0 but for rounding
    assert model.bias == pytest.approx(want["bias"])
    assert 0 < len(got) < len(z)  # the penalty leaves some at 0
    scores = toxicity.probabilities(pa.array(texts), model)
    assert scores == pytest.approx([1 / (1 + math.exp(-sum(want.get(k, 0) * v for k, v in x.items()) - want["bias"])) for x in held], abs=1e-5)
