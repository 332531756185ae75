"""Every operator against its brute-force version, on rows with nulls, repeats, ties, empty and long texts and clashing columns."""

import collections
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from quarry.llm import decontaminate, langid, linededup, packing, pii, quality, secrets, sketch, simhash, substring, suffix
from tests.llm import brute

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def bag(items):
    return collections.Counter(map(tuple, items))


# --- 1 line dedup


@pytest.mark.parametrize("options", [{}, {"frequent": 0, "rounds": (1, None)}])
def test_line_dedup(docs, rows, options, monkeypatch):
    if options:
        monkeypatch.setattr(linededup, "SMALL_GROUP", 2)
    got = linededup.deduplicate(docs, **options)
    assert got.columns == [*docs.columns, "n_lines", "n_removed"]
    assert bag(got.select("doc_id", "n_lines", "n_removed", "text").collect()) == bag(brute.line_dedup(rows))


def test_line_dedup_second_round(spark, monkeypatch):
    """A set whose first candidates all fail asks the rest."""
    monkeypatch.setattr(linededup, "SMALL_GROUP", 1)
    r = random.Random(2)
    base = [f"w{k}" for k in range(20)]
    rows = []
    for i in range(120):
        line = base[:]
        for k in r.sample(range(20), r.randint(0, 6)):
            line[k] = f"x{r.randrange(40)}"
        rows.append((i, " ".join(line), None, None))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    got = linededup.deduplicate(docs, rounds=(1, 2, None))
    assert bag(got.select("doc_id", "n_lines", "n_removed", "text").collect()) == bag(brute.line_dedup(rows))


@pytest.mark.parametrize("options", [{}, {"frequent": 0, "rounds": (1, None)}])
def test_line_dedup_of_long_lines(spark, options, monkeypatch):
    """Near copies about the threshold of 0.8, of sizes where the parity bits change their number; pairs are sent in small batches."""
    monkeypatch.setattr(linededup, "GATHER_PAIRS", 3)
    r = random.Random(7)
    rows = []
    for size in (40, 62, 70, 125, 132, 250, 262, 600):
        base = [f"s{size}w{k}" for k in range(size)]
        rows.append(" ".join(base))
        for _ in range(8):
            line = base + [f"more{r.randrange(10**6)}" for _ in range(r.randrange(size // 8))]
            for k in r.sample(range(size), r.randint(size // 14, size // 7)):
                line[k] = f"x{r.randrange(10**6)}"
            r.shuffle(line)
            rows.append(" ".join(line))
    r.shuffle(rows)
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    want = brute.line_dedup([(i, text, None, None) for i, text in enumerate(rows)])
    assert 8 < sum(x[2] for x in want) < len(rows) - 8
    assert bag(linededup.deduplicate(docs, **options).select("doc_id", "n_lines", "n_removed", "text").collect()) == bag(want)


def test_ranges_of_sizes_cover_every_size_that_can_match():
    n = np.arange(1, 5000)
    of = linededup._class(n)
    assert (np.diff(of) >= 0).all()
    low, high = of[-(-n * 4 // 5) - 1], of[np.minimum(n * 5 // 4, 4999) - 1]
    assert ((low <= of) & (of <= high)).all() and (high - low).max() < 12


def _word_sets(sets):
    """Word sets as the operator has them, with levels from random counts."""
    words = sorted({w for s in sets for w in s})
    r = random.Random(4)
    level = {w: r.choice([8, 16, 40, 80]) for w in words}
    found = object.__new__(linededup._Sets)
    found.n = np.array([len(s) for s in sets])
    found.begin = np.cumsum(found.n) - found.n
    found.line = np.arange(len(sets))
    code = {w: np.uint64(r.getrandbits(44) << 20) for w in words}
    found.h = np.array([code[w] for s in sets for w in s], np.uint64)
    found.level = np.array([level[w] for s in sets for w in s], np.uint8)
    return found


def test_sets_that_match_share_a_part():
    r = random.Random(3)
    rarity = sketch.Levels(np.array([80], np.uint8), 16)
    for n in [*range(1, 70), 100, 127, 128, 129, 159, 160, 161, 300, 511, 512, 640]:
        sets = []
        for k in range(12):
            m = min(n * 5 // 4, n + r.randrange(n // 4 + 1) if k else n * 5 // 4)
            common = -(-4 * (n + m) // 9)
            if common <= n:
                sets += [[*range(common), *range(10_000, 10_000 + n - common)], [*range(common), *range(20_000, 20_000 + m - common)]]
        for x, y in zip(sets[::2], sets[1::2]):
            shift = r.randrange(10**6)
            found = _word_sets([[w + shift for w in x], [w + shift for w in y]])
            own = linededup._tokens(found, rarity)
            assert set(own["word"][own["at"] == 0]) & set(own["word"][own["at"] == 1]), (len(x), len(y))


def test_lines_of_common_words_that_match_none_send_few_postings(spark, monkeypatch):
    """Every word is in many lines, but few parts are in two: less than half as many postings as words in the prefixes of the lines."""
    r = random.Random(6)
    rows = [(i, " ".join(r.sample([f"w{k}" for k in range(400)], 40))) for i in range(600)]
    sent, keep = [], linededup.materialised

    def counted(df):
        out = keep(df)
        if "wide" in out.columns:
            sent.append(out)
        return out

    monkeypatch.setattr(linededup, "materialised", counted)
    got = linededup.deduplicate(spark.createDataFrame(rows, "doc_id long, text string"))
    assert bag(got.select("doc_id", "text").collect()) == bag(rows)
    prefix_words = 600 * 9
    (postings,) = sent
    assert sum(len(x.id) for x in postings.select("id").collect()) < prefix_words / 2


def test_line_dedup_drops_emptied_documents_only(spark):
    docs = spark.createDataFrame([(1, "a b c d e f\nx"), (2, "a b c d e f"), (3, ""), (4, None), (5, "new\na b c d e f")], "doc_id long, text string")
    got = {x.doc_id: x.text for x in linededup.deduplicate(docs, drop_emptied=True).collect()}
    assert got == {1: "a b c d e f\nx", 3: "", 4: None, 5: "new"}


# --- 2 SimHash


def test_near_duplicates(docs, rows):
    assert bag(simhash.near_duplicates(docs).collect()) == bag(brute.near_duplicates(rows))


def test_one_of_each_group_stays(docs, rows):
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert bag((x.doc_id,) for x in kept.collect()) == bag((i,) for i in brute.near_duplicates(rows, one_of_each=True))


@pytest.mark.parametrize("max_bits", [1, 2, 3, 4])
def test_links_connect_exactly_the_pairs_within_the_distance(spark, max_bits):
    r = random.Random(max_bits)
    fps = [r.getrandbits(64) for _ in range(40)]
    for _ in range(160):
        fps.append(r.choice(fps) ^ sum(1 << b for b in r.sample(range(64), r.randint(1, 6))))
    parent = {f: f for f in fps}

    def root(f):
        while parent[f] != f:
            f = parent[f]
        return f

    for a in fps:
        for b in fps:
            if bin(a ^ b).count("1") <= max_bits:
                parent[root(a)] = root(b)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), max_bits, 8).collect()
    back = {f: f for f in fps}

    def top(f):
        while back[f] != f:
            f = back[f]
        return f

    for a, b in edges:
        a, b = a % (1 << 64), b % (1 << 64)
        back[top(a)] = top(b)
    want, got = collections.defaultdict(set), collections.defaultdict(set)
    for f in fps:
        want[root(f)].add(f)
        got[top(f)].add(f)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, got.values()))


# --- 3 quality rules


def test_quality(docs, rows, monkeypatch):
    got = quality.rate_documents(docs)
    want = brute.quality(rows, quality.RATES, quality.FENCE, quality.MIN_ROWS)
    assert bag(got.select("doc_id", *quality.COUNTS[:5], "base_failed", "kept").collect()) == bag(want)
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert bag(kept.select("doc_id").collect()) == bag((x[0],) for x in want if x[-1])


def test_thresholds_of_large_groups_are_their_own(spark):
    r = random.Random(9)
    rows = [(i, " ".join("abcdefgh"[: 2 + (i % 2) * 4] + str(r.random())[2:5] for _ in range(60)), "en", "ab"[i % 2]) for i in range(300)]
    rows.append((300, " ".join("abcdefghijklmnop"[:16] + str(r.random())[2:5] for _ in range(60)), "en", "a"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = bag(quality.rate_documents(docs).select("doc_id", *quality.COUNTS[:5], "base_failed", "kept").collect())
    want = brute.quality(rows, quality.RATES, quality.FENCE, quality.MIN_ROWS)
    assert got == bag(want) and [x[0] for x in want if not x[-1]] == [300]


# --- 4 decontamination


ITEMS = [(1, "tarimo kel one two three four five six seven eight nine ten eleven"), (2, "short item"), (3, None), (4, "..."), (None, "an item that has no number but some words"), (2, "short item")]


@pytest.mark.parametrize("broadcast_words", [decontaminate.BROADCAST_WORDS, 0])
def test_decontamination(spark, rows, broadcast_words, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", broadcast_words)
    passage = ITEMS[0][1]
    more = [
        (200, "before " + passage.upper().replace(" ", ", ") + " after", None, None), (201, passage.replace("eleven", "twelve"), None, None), (202, "a very SHORT: item here", None, None),
        (203, "An item that has no number but some words!", None, None), (204, passage + " " + passage, None, None), (205, "one two three four five", None, None), (205, passage, None, None),
    ]
    every = rows + more
    table = spark.createDataFrame([x[:2] for x in every], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = {(x.doc_id, x.item_id): round(x.similarity, 9) for x in decontaminate.leaks(table, items).collect()}
    want = brute.leaks(every, ITEMS)
    assert got == want and {(200, 1), (201, 1), (202, 2), (203, None), (204, 1)} <= set(want)
    left = decontaminate.without_leaks(table, items)
    assert bag(left.select("doc_id").collect()) == bag((i,) for i, t, *_ in every if not brute.leaks([(i, t)], ITEMS))


def test_passages_with_far_fingerprints_are_found(spark):
    """One word of fifty changed leaves a similarity of 41/51, and a few fingerprints differ in more than 15 bits."""
    r = random.Random(8)
    items = [(j, " ".join(f"w{j}x{k}" for k in range(50))) for j in range(20)]
    rows = []
    for i in range(300):
        changed = items[i % 20][1].split(" ")
        changed[r.randrange(4, 46)] = f"x{i}"
        rows.append((i, " ".join([f"a{i}"] * (i % 3) + changed + [f"b{i}"] * (i % 2)), None, None))
    table = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.leaks(table, asked).collect()
    assert {(x.doc_id, x.item_id): round(x.similarity, 9) for x in got} == brute.leaks(rows, items) and len(got) == 300
    far = sum(x.distance > 15 for x in got)
    assert far and decontaminate.leaks(table, asked, radius=15).count() == 300 - far
    assert bag(decontaminate.leaks(table, asked, radius=None).collect()) == bag(got)  # recall 1 of the default radius


def test_every_near_fingerprint_shares_a_block(spark):
    for radius in (3, 15):
        blocks = decontaminate._blocks(radius)
        assert len(blocks) == radius + 1 and sum(n for _, n in blocks) == 64
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    table = spark.createDataFrame([(words,)], "words array<string>").withColumn("s", decontaminate._shingles(5))
    row = table.selectExpr("s", f"{decontaminate._fingerprint('s')} as fp").first()
    want = sum(1 << b for b in range(64) if 2 * sum((h >> b) & 1 for h in row.s) > len(row.s))
    assert row.fp % (1 << 64) == want


# --- 5 personal data


def test_base_spans_match_plain_patterns():
    r = random.Random(3)
    for _ in range(20_000):
        t = "".join(r.choice("a1@.+-( )%é09256") for _ in range(r.randint(0, 28)))
        assert pii.base_spans(t) == brute.personal(t), t
    pii.base_spans("1" * 100_000 + "a@" * 50_000 + "+1 " * 20_000 + "1.1" * 50_000 + "a" * 100_000)  # linear


def test_personal_data(docs, rows):
    got = collections.defaultdict(list)
    for x in pii.find(docs).collect():
        got[x.doc_id].append(x)
    assert sum(map(len, got.values())) == len(rows)
    for i, t, *_ in rows:
        base = sorted(brute.personal(t))
        for x in got[i] if i is not None else []:
            if sum(1 for j, *_ in rows if j == i) == 1:
                assert tuple(x)[1:5] == tuple(sum(s[0] == k for s in base) for k in range(4))
                assert set(filter(None, pii._joined(base).split(","))) <= set(x.spans.split(","))


def test_the_field_carries_labels_to_similar_words():
    texts = [f"call +1 ({200 + k}) 555-{1000 + k} or write a{k}@mail.example.com from 10.{k}.0.7, in {1900 + k} we had {k} men" for k in range(60)]
    field = pii.fit(texts)
    text = "ask +1 (702) 555-0742 first and then (702) 555-0742 in 1999"
    (_, _, nodes), = pii._nodes(pa.array([text]))
    base = pii.base_spans(text)
    added = [text[a:b] for _, a, b in pii.added_spans(field, nodes, base)]
    assert [text[a:b] for _, a, b in base] == ["+1 (702) 555-0742"] and added == ["(702) 555-0742"]
    p = pii.posterior(field, nodes, pii._labels(nodes, base))
    assert np.allclose(p.sum(1), 1)


# --- 6 suffix-array dedup


def test_suffix_array_orders_all_suffixes():
    r = random.Random(1)
    for _ in range(300):
        data = bytes(r.randrange(97, 97 + r.choice([1, 2, 3, 26])) for _ in range(r.randint(1, 300))) * r.randint(1, 2)
        order = suffix.suffix_array(np.frombuffer(data, np.uint8), 20)
        assert sorted(order.tolist()) == list(range(len(data)))
        keys = [data[i : i + 20] for i in order]
        assert keys == sorted(keys)


@pytest.mark.parametrize("hot_contents", [5_000, 1])
def test_suffix_dedup(docs, rows, hot_contents):
    assert bag(suffix.deduplicate(docs, hot_contents=hot_contents).collect()) == bag(brute.suffix_dedup(rows))


@pytest.mark.parametrize("unit", [99, 100, 101, 102])
def test_suffix_dedup_of_a_unit_repeated_in_one_text(spark, unit):
    """A window of 200 bytes holds 101 anchors, so the minimizer of a unit of 101 bytes stands once in each window."""
    r = random.Random(unit)
    rows = []
    for i, copies in enumerate((1, 2, 3, 10, 50)):
        line = "".join(r.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(unit - 1)) + "\n"
        rows.append((i, line * copies, None, None))
    docs = spark.createDataFrame([x[:2] for x in rows], "doc_id long, text string")
    assert bag(suffix.deduplicate(docs).collect()) == bag(brute.suffix_dedup(rows))


# --- 7 secrets


def test_secrets(docs, rows):
    want = bag((i, *brute.secrets(t, secrets.ALLOWED, secrets.CLASSES, secrets.WINDOW, secrets.SCALE)) for i, t, *_ in rows)
    got = bag(secrets.scan(docs).collect())
    assert got == want
    assert sum(x[5] for x in got) and sum(x[1] for x in got) and sum(x[2] for x in got) and sum(x[3] for x in got)


def test_allowed_candidates_are_left_alone(spark):
    texts = ["123e4567-e89b-12d3-a456-426614174000", "Zx9Qw3Er7Ty1Ui5Op2As4Df6Gh8", "EXAMPLEkeyZx9Qw3Er7Ty1Ui5Op2", "a1" * 40]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {x.doc_id: x.n_entropy for x in secrets.scan(docs).collect()} == {0: 0, 1: 1, 2: 0, 3: 0}


def test_keys_beside_allowed_words_and_of_letters_only_are_scored(spark):
    key, letters = "Zx9Qw3Er7Ty1Ui5Op2As4Df6Gh8", "QwErTyUiOpAsDfGhJkLzXcVbNm"
    texts = ["/examples/" + key, key + "=placeholder", f"{key}/EXAMPLE/{key[::-1]}", letters, "/" + letters + "/", "EXAMPLE" + key, "a" * 40, "some-dashed-words-without-digits", "x" * 8 + letters]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {x.doc_id: x for x in secrets.scan(docs).collect()}
    assert [got[k].n_entropy for k in range(len(texts))] == [1, 1, 2, 1, 1, 0, 0, 0, 0]
    assert got[0].spans == "entropy:9:37" and got[2].spans == "entropy:0:28,entropy:35:63"


def test_identifiers_and_paths_are_left_alone_and_random_keys_are_not(spark):
    names = ["ThisIsAVeryLongCamelCaseIdentifierNameForTests", "getElementsByClassNameAndAttribute", "MethodInvocationHandlerProxyFactoryBean", "/usr/local/lib/python/site-packages/numpy", "user+tag=value/otherPathSegmentHere"]
    r = random.Random(11)
    keys = ["".join(r.choice("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ") for _ in range(40)) for _ in range(60)]
    texts = [*names, *keys, "x/" + "/".join(keys[:2]) + "-EXAMPLE", *(k[:20] + "9" + k[20:] for k in keys[:20]), "word 12345678901234567890 +/+/+/+/+/+/+/+/+/+/+/ " + keys[3]]
    got = {x.doc_id: x for x in secrets.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert not any(got[k].n_entropy for k in range(len(names)))
    assert sum(got[k].n_entropy > 0 for k in range(len(names), len(names) + len(keys))) >= 0.9 * len(keys)
    assert bag(got.values()) == bag((i, *brute.secrets(t, secrets.ALLOWED, secrets.CLASSES, secrets.WINDOW, secrets.SCALE)) for i, t in enumerate(texts))


# --- 8 language identification


def test_language_identification_on_held_out_documents(spark):
    r = random.Random(4)
    pools = {"en": ["the", "with", "thing", "and", "of"], "de": ["der", "schön", "und", "nicht", "größe"], "es": ["el", "niño", "que", "los", "ción"]}
    rows = [(i, " ".join(r.choice(pools[lang]) for _ in range(30)), lang) for i in range(150) for lang in [r.choice(list(pools))]]
    rows += [(150, None, "en"), (151, "123 !! ½", "en"), (152, "", None), (None, "the thing", None), (153, "DER SCHÖNE", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in langid.identify(docs).collect()}
    want = {i: lang for i, _, lang in rows}
    held = [x for i, x in got.items() if x.held_out and i < 150]
    assert len(held) > 20 and sum(x.lang_pred == want[x.doc_id] for x in held) >= 0.95 * len(held)
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (150, 151, 152))
    assert got[None].lang_pred == "en" and not got[None].held_out and got[153].lang_pred == "de"
    assert all(0 <= x.score <= 1 for x in got.values())


@pytest.mark.parametrize("piece, cells", [(250_000, 1 << 21), (700, 64)])
def test_languages_are_those_of_plain_naive_bayes(docs, rows, piece, cells, monkeypatch):
    monkeypatch.setattr(langid, "_PIECE_CHARS", piece)
    monkeypatch.setattr(langid, "SCORE_CELLS", cells)
    model = langid.train(docs.filter(~langid.held_out("doc_id")))
    want = collections.Counter((i, lang, round(p, 6)) for i, lang, p in brute.languages(rows, len(model.log_p), langid.SMOOTHING))
    got = collections.Counter((x.doc_id, x.lang_pred, round(x.score, 6)) for x in langid.identify(docs).collect())
    assert got == want and {"und", "en", "de"} <= {lang for _, lang, _ in want}


def test_a_prediction_does_not_use_language_source_or_id(spark):
    docs = spark.createDataFrame([(i, "der und nicht" if i % 2 else "the and with", "de" if i % 2 else "en") for i in range(30)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    got = langid.predict(docs.selectExpr("doc_id", "text", "'xx' as lang"), model).collect()
    assert all(x.lang_pred == ("de" if x.doc_id % 2 else "en") for x in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(x.lang_pred, x.score) for x in langid.identify(docs).collect()] == [("und", 0.0)]


def test_language_identification_with_clashing_columns(docs, rows):
    assert langid.identify(docs).count() == len(rows)


# --- 9 substring dedup


def test_substring_dedup(docs, rows):
    assert bag(substring.deduplicate(docs).collect()) == bag(brute.substring_dedup(rows))


def test_substring_text_is_what_is_left(spark):
    passage = " ".join(f"w{k}" for k in range(20))
    docs = spark.createDataFrame([(1, passage), (2, f"new {passage}\tend")], "doc_id long, text string")
    got = {x.doc_id: (x.kept_text, x.n_removed) for x in substring.deduplicate(docs, with_text=True).collect()}
    assert got == {1: (passage, 0), 2: ("new end", 20)}


# --- 10 packing


def _places(got):
    sequences = collections.defaultdict(list)
    for x in got:
        sequences[x.sequence_id].append((x.offset, x.length))
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048
    return len(sequences)


def test_packing(docs, rows):
    got = packing.pack(docs, TOKENIZER).collect()
    want = brute.pieces(rows, Tokenizer.from_file(TOKENIZER))
    assert bag(tuple(x)[:5] for x in got) == bag(want)
    total = sum(x[3] for x in want)
    assert _places(got) == -(-total // 2048)  # as few as the tokens allow


def test_ids_of_odd_words_are_the_tokenizers():
    tokenizer, words = Tokenizer.from_file(TOKENIZER), packing._WordIds(TOKENIZER)
    r = random.Random(1)
    alphabet = "aAbBéÉßüÜıİſΣσςñ'’sStTdD.,;:!?%&$*#|-_09²½ \n\t\xa0 \x1c\x85ééªºŉǅ日本語<>@/\x00"
    texts = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 30))) for _ in range(5_000)] + ["they're <|endoftext|> x<|startoftext|>.", "İstanbul."]
    for text, ids in zip(texts, words.of(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_plan_fills_bins_and_replaces_the_smallest():
    # greedy alone puts 6 + 3 into a bin of 10; 6 + 2 + 2 fits it tightly
    slots, bins = packing.plan({6: 1, 3: 1, 2: 2}, 10)
    assert bins == 2 and sorted(zip(slots["length"], slots["bin"])) == [(2, 0), (3, 1), (6, 0)]
    r = random.Random(7)
    for _ in range(50):
        histogram = {r.randint(1, 64): r.randint(1, 50) for _ in range(r.randint(1, 20))}
        slots, bins = packing.plan(histogram, 64)
        assert bins >= -(-sum(a * b for a, b in histogram.items()) // 64)
        fill = collections.Counter()
        for length, rank, each, first, _ in zip(*slots.values()):
            later = [x for x in slots["rank"][slots["length"] == length] if x > rank]
            n = (min(later) if later else histogram[length]) - rank
            assert n % each == 0
            for b in range(n // each):
                fill[first + b] += each * length
        assert len(fill) == bins and max(fill.values()) <= 64


# --- all


def test_empty_tables(spark, nothing):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for out in (
        linededup.deduplicate(nothing), simhash.near_duplicates(nothing), simhash.keep_one_of_each_group(nothing), quality.rate_documents(nothing), quality.keep_good(nothing), decontaminate.leaks(nothing, items),
        decontaminate.without_leaks(nothing, items.limit(0)), pii.find(nothing), suffix.deduplicate(nothing), secrets.scan(nothing), langid.identify(nothing), substring.deduplicate(nothing), packing.pack(nothing, TOKENIZER),
    ):
        assert out.count() == 0


def test_a_sketch_never_counts_too_low(spark):
    values = [k % 700 for k in range(3000)]
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(4)
    hashes = lambda batch: [sketch.signed_hashes(batch.column(0)) * np.uint64(0x9E3779B97F4A7C15)]
    all_ = np.arange(100_000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    found = sketch.bitmap(df, hashes, 16, 5, 2).has(all_)
    assert found[:200].all() and found[700:].mean() < 0.01
    levels = sketch.levels(df, hashes, 16).of(all_)
    assert (levels[:200] >= int(8 * np.log2(6))).all() and (levels[200:700] >= int(8 * np.log2(5))).all()
