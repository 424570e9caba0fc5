import random
import pytest
from pyspark.sql import functions as F

from termloom.functions.analysis import LANGUAGES, analyze
from termloom.functions.cjk import cjk_bigrams, cjk_width
from termloom.functions.folding import fold, fold_text
from termloom.functions.light_stem import stem_tokens_light
from termloom.functions.stem_en import porter_stem, stem_tokens_en
from termloom.functions.tokens import elision, num_words, tokenize

ENGLISH = [
    ("hello", 1, [], ["hello"]),
    ("Hello world!", 1, [], ["hello", "world"]),
    ("stemming tests", 1, [], ["stem", "test"]),
    ("Bob's questions rock!", 1, [], ["bob", "question", "rock"]),
    ("feature category", 1, [], ["featur", "categori"]),
    (
        "Hello there world!",
        3,
        [],
        ["hello", "there", "world", "hello there", "there world", "hello there world"],
    ),
    ("Hello there world!", 3, ["there"], ["hello", "world"]),
    ("Hello my world!", 3, [], ["hello", "world"]),
    ("my world", 3, [], ["world"]),
    ("I am 1", 3, [], []),
    ("test 20 1.456 1,324", 1, [], ["test"]),
    ("", 3, [], []),
]


@pytest.mark.parametrize("text,size,stopwords,terms", ENGLISH)
def test_english_terms(one, text, size, stopwords, terms):
    got = one(analyze("t", shingle_size=size, stopwords=stopwords), t=text)
    assert sorted(got) == sorted(terms)


def test_terms_are_in_order_of_their_last_word(one):
    got = one(analyze("t", shingle_size=2), t="alpha beta alpha")
    assert got == ["alpha", "beta", "alpha beta", "alpha", "beta alpha"]
    # the length rule comes after stemming: "one" is "on" by then
    assert one(analyze("t", shingle_size=2), t="one two red") == ["two", "red", "two red"]


def test_null_text_has_no_terms(one):
    assert one(analyze("t"), t=None) is None


def test_unknown_language_is_an_error():
    with pytest.raises(ValueError):
        analyze("t", lang="xx")
    assert "en" in LANGUAGES and "zh-cn" in LANGUAGES


PORTER = {
    "caresses": "caress", "ponies": "poni", "ties": "ti", "cats": "cat", "feed": "feed",
    "agreed": "agre", "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing",
    "conflated": "conflat", "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan",
    "falling": "fall", "hissing": "hiss", "fizzed": "fizz", "failing": "fail", "filing": "file",
    "happy": "happi", "sky": "sky", "relational": "relat", "conditional": "condit",
    "vietnamization": "vietnam", "hopefulness": "hope", "electrical": "electr", "adjustable": "adjust",
    "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    # words whose stems are in published stop-word lists of this kind
    "way": "wai", "only": "onli", "does": "doe", "i've": "i'v", "because": "becaus", "this": "thi",
    "suggest": "suggest", "possible": "possibl", "they": "thei", "tyyed": "ty",
}


def test_porter():
    assert {w: porter_stem(w) for w in PORTER} == PORTER


def test_protected_words_and_possessives(spark):
    df = spark.createDataFrame([(["heading", "dogs", "dog's", None, ""],), (None,), ([],)], "w array<string>")
    got = [r[0] for r in df.select(stem_tokens_en("w", ["heading"]).alias("s")).collect()]
    assert got == [["heading", "dog", "dog", None, ""], None, []]


TOKENS = {
    "don't stop": ["don't", "stop"],
    "mail ted@gmail.com now.": ["mail", "ted", "gmail.com", "now"],
    "1,324 and 1.456, 2;3": ["1,324", "and", "1.456", "2;3"],
    "a.1 b,c x:y 1:2": ["a", "1", "b", "c", "x:y", "1", "2"],
    "snake_case 'quoted' end'": ["snake_case", "quoted", "end"],
    "日本 word": ["日", "本", "word"],
    "--- ...": [],
}


# one text for each rule of word segmentation
WORD_RULES = {
    # extenders and format signs stay with what they follow, also before a joining mark
    "a\u0308b c\u00add e\u200df g\u200bh": ["a\u0308b", "c\u00add", "e\u200df", "g", "h"],
    "can\u0301't\u00ad\u2019s 1\u0308,\u00ad2": ["can\u0301't\u00ad\u2019s", "1\u0308,\u00ad2"],
    # letters across one mark, not across two or at an end
    "a\u2018b a\u2024b a\u2027b a\uff1ab a\uff0eb a..b \u2018a\u2018 a\u2018": [
        "a\u2018b", "a\u2024b", "a\u2027b", "a\uff1ab", "a\uff0eb", "a", "b", "a", "a"
    ],
    # numbers across one mark; a mark for letters parts numbers, and the other way round
    "1\u066c2 3\u20444 5\uff0c6 7\uff1a8 a\u066cb 1\u066b5": ["1\u066c2", "3\u20444", "5\uff0c6", "7", "8", "a", "b", "1\u066b5"],
    # Hebrew quotes
    'צה"ל ג\'ירפה ג\' 5 "א" א"5': ['צה"ל', "ג'ירפה", "ג'", "5", "א", "א", "5"],
    # katakana are runs, which letters and ideographs end and connectors do not
    "テレビabc カタ_abc 日本カタカナひら ﾊﾞﾅﾅ": ["テレビ", "abc", "カタ_abc", "日", "本", "カタカナ", "ひ", "ら", "ﾊﾞﾅﾅ"],
    "a\u203fb 1\u202f000 __ \u2040": ["a\u203fb", "1\u202f000", "__", "\u2040"],
    # runs of scripts without blanks; Hangul and others are letters
    "ภาษาไทย ພາສາ 한국어 हिन्दी العربية": ["ภาษาไทย", "ພາສາ", "한국어", "हिन्दी", "العربية"],
    # flags and emoji are no words
    "x\U0001f1e9\U0001f1eay \U0001f44d\U0001f3fd z": ["x", "y", "z"],
    "\u200b": [],
}


@pytest.mark.parametrize("text,words", WORD_RULES.items())
def test_word_rules(one, text, words):
    assert one(tokenize("t"), t=text) == words


def test_word_rules_agree_with_the_separators(one):
    # a format sign at the end makes the rules read texts that the separators read otherwise
    rng = random.Random(7)
    for _ in range(25):
        text = "".join(rng.choice("ab1_'’.,;: ·é中ひ-") for _ in range(200)) + " z"
        assert one(tokenize("t"), t=text + "\u2060") == one(tokenize("t"), t=text)[:-1] + ["z\u2060"]


@pytest.mark.parametrize("sign", ["a", "1,", "a\u2018", "א\"", "カ", "_", "\u0308", "\u2060", "\u2018", "ไ"])
def test_long_runs_under_the_rules(one, sign):
    one(F.size(tokenize("t")), t=sign * 300_000 + "\u2060")


@pytest.mark.parametrize("text,words", TOKENS.items())
def test_tokens(one, text, words):
    assert one(tokenize("t"), t=text) == words


def test_long_runs_do_not_exhaust_the_tokenizer(one):
    assert one(F.size(tokenize("t")), t="1, " * 200_000) == 200_000
    # one run of joined digits is one token, however long
    assert [len(w) for w in one(tokenize("t"), t="1," * 200_000 + " end")] == [399_999, 3]
    assert one(tokenize("t", max_token_len=255), t="x" * 255 + " " + "y" * 256) == ["x" * 255]


FOLDED = ["Straße ẞ", "ĲSSEL ﬁne ﬃ", "résumé ÀÉ résumé", "đis łódź øre", "ΜΆΪΟΣ ς", "٣٤ ০৬ １２", "𝓯ancy Ⅷ", "한국 日本", "ЁЙ"]


@pytest.mark.parametrize("text", FOLDED)
def test_folding_expression_follows_the_rule(one, text):
    assert one(fold(F.col("t")), t=text) == " ".join(fold_text(w) for w in text.split(" "))


def test_folding_examples(one):
    assert one(fold(F.col("t")), t="Straße Résumé Ĳ ０９ đ") == "strasse resume ij 09 d"
    assert one(fold(F.col("t")), t=None) is None


def test_num_words(one):
    assert [one(num_words("t"), t=t) for t in ("a", "a b", "a b c")] == [1, 2, 3]


def test_elision(spark):
    df = spark.createDataFrame([(["l'avion", "Qu’il", "aujourd'hui", "l"],)], "w array<string>")
    assert df.select(elision("w", ["l", "qu"])).first()[0] == ["avion", "il", "aujourd'hui", "l"]


LIGHT = {
    "de": {"kindern": "kind", "hauser": "haus", "wichtigsten": "wichtig", "haus": "haus"},
    "es": {"mujeres": "mujer", "luces": "luz", "casas": "cas", "meses": "mes", "casa": "casa"},
    "fr": {"chevaux": "cheval", "gouvernement": "gouvern", "heureuse": "heureu", "maisons": "maison"},
    "it": {"amiche": "amic", "pioggia": "piogg", "libro": "libro"},
    "pt": {"homens": "homem", "animais": "animal", "rapidamente": "rapid", "meninas": "menin"},
    "ru": {"книгами": "книг", "красивые": "красив", "домов": "дом"},
    "sv": {"flickorna": "flick", "husets": "hus", "pojkar": "pojk"},
    "nl": {
        "lichamelijkheden": "licham", "opgeheven": "opgehev", "katten": "kat", "bomen": "bom",
        "mogelijkheid": "mogelijk", "gelukkig": "gelukk", "maan": "man",
    },
}


@pytest.mark.parametrize("lang", LIGHT)
def test_light_stemmers(spark, lang):
    words = list(LIGHT[lang])
    df = spark.createDataFrame([(words,)], "w array<string>")
    assert dict(zip(words, df.select(stem_tokens_light("w", lang)).first()[0])) == LIGHT[lang]


def test_chinese(one):
    assert one(cjk_bigrams("t"), t="我是中国人 ABC 中") == ["我是", "是中", "中国", "国人", "abc", "中"]
    assert one(analyze("t", lang="zh-cn", min_len=1), t="ＡＢＣ中国") == ["abc", "中国"]
    assert one(cjk_width("t"), t="ＡＢ１！ｶﾞｷﾞｱ") == "AB1!ガギア"
