"""Text functions that have to be cheap for every word: same results as their plain forms."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
from checks import fixtures
from termloom.functions import tokens
from termloom.functions.cjk import cjk_bigrams
from termloom.functions.light_stem import KEEP, LIGHT_STEMMERS, DOUBLED, _function
from termloom.functions.stem_en import known_stems, stem_tokens_en
from termloom.functions.tokens import elision, shingles
from termloom.operators.terms import PIECE_WORDS, user_terms

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def grams(words, size):
    """N-grams by end, short first; words under three signs break them."""
    kept = [w if w is not None and len(w) > 2 else None for w in words]
    out = []
    for i in range(len(kept)):
        for k in range(1, size + 1):
            part = kept[max(0, i - k + 1) : i + 1]
            if len(part) == k and None not in part:
                out.append(" ".join(part))
    return out


def test_ngrams_are_made_in_rows(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["tree", "house", "of", "river"]) for _ in range(n)) for n in (0, 1, 2, 7, 2 * PIECE_WORDS + 1)]
    docs = spark.createDataFrame([("u", t) for t in texts] + [("v", None)], "email string, content string")
    found = user_terms(docs, shingle_size=3, stem=False)
    assert sorted(r.term for r in found.collect()) == sorted(g for t in texts for g in grams(t.split(), 3))
    assert "zip_with" not in plan(found)
    marked = user_terms(docs, shingle_size=3, stem=False, mark_docs=True).filter("term is null")
    assert marked.count() == len(texts) + 1


def test_shingles_in_one_pass(spark):
    words = [["tree", None, "house", "river", "hill"], [], [None], ["tree"]]
    df = spark.createDataFrame([(w,) for w in words] + [(None,)], "w array<string>")
    found = df.select(shingles("w", 3).alias("t"))
    assert [r.t for r in found.collect()] == [grams(w, 3) for w in words] + [None]
    assert "zip_with" not in plan(found)


def test_tasks_grow_with_the_texts():
    assert fixtures.pieces(15 << 20, 12) == 12
    assert fixtures.pieces(6 << 30, 12) == 384


def test_guarded_classes_hold_the_same_signs(spark):
    kata = tokens._KATAKANA.split("&&")[0]
    plain = {
        tokens._SINGLE_SIGN: r"[\p{IsHan}\p{IsHiragana}]",
        tokens._EXTEND: r"[\p{M}\p{Cf}\uFF9E\uFF9F\x{1F3FB}-\x{1F3FF}&&[^\u200B]]",
        tokens._HEBREW: r"[\p{IsHebrew}&&\p{L}]",
        tokens._LETTER: rf"[\p{{IsAlphabetic}}&&[^\p{{M}}\p{{N}}{tokens._SINGLE}{tokens._NO_BLANKS}]&&[^{kata}]]",
        tokens._RULED_SIGNS: rf"[{kata}{tokens._NO_BLANKS}\p{{IsHebrew}}\p{{Cf}}\uFF9E\x{{1F3FB}}-\x{{1F3FF}}\u202F"
        rf"\p{{Pc}}{tokens._MID_LETTER}{tokens._MID_NUMBER}{tokens._MID_BOTH}\u066B&&[^_'’.:·,;]]",
    }
    signs = [(chr(c),) for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000]
    df = spark.createDataFrame(signs, "c string")
    differ = [F.count_if(F.col("c").rlike(new) != F.col("c").rlike(old)) for new, old in plain.items()]
    assert list(df.agg(*differ).first()) == [0] * len(plain)
    assert tokens._RULED_SIGNS.startswith(r"[\u00AD\u037E-")


def test_elision_looks_for_a_mark_first(spark):
    df = spark.createDataFrame([(["l'avion", "l’eau", "avion", None, "L'an", "l"],)], "w array<string>")
    found = df.select(elision("w", ["l"]).alias("w"))
    assert found.first().w == ["avion", "eau", "avion", None, "an", "l"]
    assert "contains" in plan(found).lower()


def test_words_are_told_by_their_first_and_last_signs(spark):
    rng = random.Random(9)
    words = ["".join(rng.choices("abS:sſ'’＇1,.٣９\u0080_é\x7f𝟘", k=rng.randrange(6))) for _ in range(4000)] + [None]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    noise = (F.length("w") < 2) | F.col("w").rlike(r"^[\p{Nd},.]+$") | F.col("w").isin("abs", "'s")
    owned = F.lower(F.substr("w", F.lit(-2))).isin("'s", "’s", "＇s")
    base = F.when(owned, F.substr("w", F.lit(1), F.length("w") - 2)).otherwise(F.col("w"))
    new = tokens.is_noise_word("w", ["abs", "'s"], 2), tokens.possessive_base("w")
    same = [F.count_if(~a.eqNullSafe(b)) for a, b in zip(new, (noise, base), strict=True)]
    assert list(df.agg(*same, F.count_if(noise), F.count_if(owned)).first())[:2] == [0, 0]
    assert "endswith" in str(tokens.possessive_base("w")).lower() and "<" in str(tokens.is_noise_word("w"))


RUN = re.compile(r"[\u4e00-\u9fff\u3041-\u309f\u30a1-\u30fa\uac00-\ud7a3]+|[^\s\u4e00-\u9fff\u3041-\u309f\u30a1-\u30fa\uac00-\ud7a3]+")


def test_chinese_terms_in_one_pass(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("天地玄黄ひカ한ab1_,.' é\n") for _ in range(n)) for n in range(40)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)] + [(99, None)], "i int, t string")
    found = df.select("i", cjk_bigrams("t").alias("w"))
    parts = df.filter("t is not null").select("i", F.lower("t").alias("t")).collect()
    # parts one by one: pairs of runs, words of everything else
    rest = [(r.i, n, p) for r in parts for n, p in enumerate(RUN.findall(r.t))]
    words = spark.createDataFrame(rest, "i int, n int, p string").select("i", "n", "p", tokens.tokenize("p").alias("w"))
    want = {r.i: [] for r in parts}
    for r in sorted(words.collect(), key=lambda r: (r.i, r.n)):
        run = re.match(r"[\u3041-\u30fa\u4e00-\ud7a3]", r.p)
        want[r.i] += ([r.p[k : k + 2] for k in range(len(r.p) - 1)] or [r.p]) if run else r.w
    assert {r.i: r.w for r in found.collect()} == want | {99: None}
    assert "sequence" not in plan(found)


@pytest.mark.parametrize("lang", sorted(LIGHT_STEMMERS))
def test_rules_by_last_sign_leave_none_out(lang):
    rng = random.Random(7)
    letters = "аеиоуйыьямнхгюёв" if lang == "ru" else "aeioustnrdhklmgjbcxyzvw"
    for step in LIGHT_STEMMERS[lang]:
        if isinstance(step, tuple):
            continue
        by_last = _function(step)
        for _ in range(3000):
            word = "".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) + rng.choice(["", "", "~", "=", "!"])
            want = word
            for pattern, replacement in step:
                if re.search(pattern, word):
                    if replacement is not KEEP:
                        want = re.sub(pattern, re.sub(r"\$(\d)", r"\\g<\1>", replacement), word)
                    break
            assert by_last(word) == want, word


def test_doubled_letters_become_single():
    single = _function(DOUBLED)
    assert [single(w) for w in ("aabbcc", "abb", "a1122b", "жжжукк")] == ["abc", "abb", "a1122b", "жук"]


@pytest.mark.parametrize("name", ["unique_count_sketched", "stopword_exclusion"])
def test_texts_are_not_taken_apart_again(spark, name):
    # what is read several times is a staged table: the result's plan holds no scan of the texts
    assert "documents.parquet" not in plan(driver.queries()[name](spark, SF_DIR))


def test_stems_are_kept_from_task_to_task(spark):
    known_stems("some")["walking"] = "walk"
    assert known_stems("some") == {"walking": "walk"} and known_stems("other") == {}
    # workers that have stemmed by other rules give no stems of theirs
    words = spark.createDataFrame([(["walking", "heading"],)] * 40, "w array<string>").repartition(8)
    for protected, want in (([], ["walk", "head"]), (["heading"], ["walk", "heading"]), (["walking"], ["walking", "head"])):
        assert [r.s for r in words.select(stem_tokens_en("w", protected).alias("s")).collect()] == [want] * 40
