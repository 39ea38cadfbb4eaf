"""Column builders for text: normalising, words, sentences, shingles, repetition, languages, answers, secrets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space of any script, and words of letters, digits and underscores, in a form that Java and RE2 read alike.
SPACE = r"[\s\x0B\x1c-\x1f\x85\p{Z}]+"
WORD = r"[\p{L}\p{N}_]+"

# Letters and words that the language rules count.
VIETNAMESE_LETTERS = "ăâđêôơưàáảãạằắẳẵặầấẩẫậèéẻẽẹềếểễệìíỉĩịòóỏõọồốổỗộờớởỡợùúủũụừứửữựỳýỷỹỵ"
ENGLISH_WORDS = "the of and to is in that for it with as be on are this by an we can if not or from at which you have will what how was".split()
VIETNAMESE_ASCII_WORDS = "khong cua nhung duoc trong nguoi voi mot nay cac nhu thi cho minh ban toi lam nhieu cung chung dung phai nhat".split()

# The patterns of prose(), strip_think(), extract_code(), normalize_answer() and answer_numbers() are fixed values, too.

# What counts as a secret in a text, and in a shell assignment.
SECRET = r"(?i)(hf_[a-z0-9]{20,}|(api[_-]?key|password|secret)\s*[=:]\s*\S{8,})"
SECRET_SHELL = r"""(^|[^A-Za-z0-9_$])[A-Z0-9_]*PASS[A-Z0-9_]*=(["']?[A-Za-z0-9!@#%^&*+./-]{4,}|["']?\$\{[A-Za-z0-9_]+:-[^}$]{4,}\})"""


def let(value: Column, f) -> Column:
    """f of a value that is worked out once for a row, however often f mentions it, also inside lambdas."""
    return F.transform(F.array(value), f)[0]


#: White space other than line feeds, where it is not one blank.
_BESIDE = r" [\t\x0B\f\r \x1c-\x1f\x85\p{Z}]+|[\t\x0B\f\r\x1c-\x1f\x85\p{Z}&&[^ ]][\t\x0B\f\r \x1c-\x1f\x85\p{Z}]*"
#: Runs of white space that are not one blank, so that a text is not written anew for every word.
_UNEVEN = rf" {SPACE}|[{SPACE[:-1]}&&[^ ]]{SPACE[:-1]}*"


#: Other than visible ASCII, the blank and letters below U+1680: a quick test that most texts pass. Of what it finds, _SPACES tells whether white space is among it.
_ODD = r"[^ -~\xa1-\u167f]"
_SPACES = f"[{SPACE[1:-2]}&&[^ ]]"


def collapse(c: Column) -> Column:
    """White space as single blanks, trimmed. Line feeds are the usual kind; a text with no other kind and no two blanks in a row is not searched any further."""
    uneven = lambda x: F.contains(x, F.lit("  ")) | (x.rlike(_ODD) & x.rlike(_SPACES))
    return let(F.replace(c, F.lit("\n"), F.lit(" ")), lambda x: F.trim(F.when(uneven(x), F.regexp_replace(x, _UNEVEN, " ")).otherwise(x)))


#: Characters that are in NFC next to any others of these, and that lower case and ß to ss fold whole (a test holds it against the Unicode tables).
PLAIN = "\u0000-\u00b4\u00b6-\u012f\u0131-\u0148\u014a-\u017e\u0180-\u01ef\u01f1-\u02ff\u0400-\u0482\u048a-\u052f\u1ea0-\u1eff\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u2190-\u21cc\u2500-\u27bf\u3001-\u3020\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fff\uac00-\ud7a3"
_BEYOND = f"[^{PLAIN}]"
#: The parts of PLAIN that whole texts are written in, a class of few ranges each: Java tries every range of a class for every character.
_SCRIPTS = ("\u0000-\u00b4\u00b6-\u012f", "\u1ea0-\u1eff\u0131-\u0148\u2010-\u2027", "\u0400-\u0482\u048a-\u052f", "\u4e00-\u9fff\uac00-\ud7a3", "\u3001-\u3020\u3041-\u3096\u30a1-\u30fa")


def _beyond(c: Column) -> Column:
    """Whether a text has other than PLAIN characters; nfc() and fold() do not ask, as the library is quicker than this test. ASCII is told by its bytes; of others, runs of each script are taken out and only what remains is tried against all of PLAIN."""
    left = c
    for chars in _SCRIPTS:
        left = F.regexp_replace(left, f"[{chars}]+", "")
    return (F.octet_length(c) != F.length(c)) & c.rlike(f"[^{_SCRIPTS[0]}]") & left.rlike(_BEYOND)


def _compose(c: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(False))


def _fold_case(c: Column) -> Column:
    return F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), c, F.lit(True))


def nfc(c: Column) -> Column:
    """Canonical composition, for every script, by the Unicode library that Spark itself uses and ships.

    It takes every text: telling first by patterns which texts need it costs many times what it does. Spark takes every call by reflection for one that may give another result
    the next time, so nfc(), fold() and what is built on them belong in a select, not inside an aggregate or a join's
    condition.
    """
    return let(c, lambda x: F.when(x.isNotNull(), _compose(x)))


def fold(c: Column) -> Column:
    """Full case folding, for every script; see nfc()."""
    return let(c, lambda x: F.when(x.isNotNull(), _fold_case(x)))


def folded_nfc(c: Column) -> Column:
    """NFC, folded; null is the empty text. See nfc() for where it may stand."""
    return _fold_case(_compose(F.coalesce(c, F.lit(""))))


def normalize(c: Column) -> Column:
    """NFC, folded, white space collapsed, trimmed; null is the empty text. See nfc() for where it may stand."""
    return collapse(folded_nfc(c))


def strip(c: Column, chars: str) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^[{chars}]+", ""), f"[{chars}]+$", "")


def prose(c: Column) -> Column:
    """Without fenced code, which may run to the end, and LaTeX commands."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)```.*?(```|$(?![\r\n]))", " "), r"\\[A-Za-z]+", " ")


def words(c: Column) -> Column:
    return F.regexp_extract_all(c, F.lit(WORD), F.lit(0))


def sentences(c: Column) -> Column:
    """Trimmed sentences that are not empty: split after . ! ? 。 and white space, and at line feeds."""
    lines = F.regexp_replace(F.regexp_replace(c, r"([.!?。])\s+", "$1\n"), _BESIDE, " ")
    return F.filter(F.split(F.trim(lines), r" *\n[ \n]*"), lambda s: s != "")


def ngrams(w: Column, n: int) -> Column:
    """Runs of n words, joined; none for fewer words. The words hold no blank, so one scan of all of them, joined, looks ahead from each for its run: no part of the array is copied for a run."""
    return F.regexp_extract_all(F.array_join(w, " "), F.lit(rf"(?:^| )(?=([^ ]++(?: [^ ]++){{{n - 1}}}))"), F.lit(1))


def shingles(w: Column, n: int) -> Column:
    """The set of runs of n words; a shorter text is one run, a text without words none."""
    none = F.array().cast("array<string>")
    return let(w, lambda w: F.when(F.size(w) == 0, none).when(F.size(w) < n, F.array(F.array_join(w, " "))).otherwise(F.array_distinct(ngrams(w, n))))


def repeated_share(items: Column) -> Column:
    """1 - distinct / all, 0 for none."""
    return let(items, lambda x: F.when(F.size(x) == 0, F.lit(0.0)).otherwise(1 - F.size(F.array_distinct(x)) / F.size(x)))


def duplicate_sentence_share(c: Column, least: int = 20) -> Column:
    return repeated_share(F.filter(sentences(fold(c)), lambda s: F.length(s) >= least))


def longest_word_run(w: Column) -> Column:
    """Longest run of one word; words with fewer than two letters end a run and count for none. The words hold no blank: one scan of all of them, joined, finds the words that stand there twice and more in a row."""
    runs = lambda w: F.regexp_extract_all(F.array_join(w, " "), F.lit(r"(?:^| )([^ ]++)(?: \1(?= |$))+"), F.lit(0))
    real = lambda x: x.rlike(r"^ ?[^ \p{L}]*\p{L}[^ \p{L}]*\p{L}")
    longest = lambda w: F.array_max(F.transform(F.filter(runs(w), real), lambda x: F.size(F.split(F.trim(x), " "))))
    return let(w, lambda w: F.greatest(longest(w), F.exists(w, real).cast("int")))


def count_class(c: Column, chars: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{chars}]", ""))


def count_letters(c: Column, letters: str) -> Column:
    return F.length(c) - F.length(F.translate(c, letters, ""))


#: Letters of other scripts than Latin, and Latin characters that are no letters.
_LETTER_OR_LATIN = r"[\p{L}&&[^\p{IsLatin}]]|[\p{IsLatin}&&[^\p{L}]]"


def detect_language(c: Column) -> Column:
    """vi, vi-khong-dau, en, other or unknown, by shares of letters and of common words."""
    share = lambda w, names: F.size(F.filter(w, lambda x: x.isin(names)))
    by_words = lambda low: let(words(low), lambda w: F.when(share(w, VIETNAMESE_ASCII_WORDS) * 100 >= F.size(w) * 8, "vi-khong-dau").when(share(w, ENGLISH_WORDS) * 20 >= F.size(w), "en").otherwise("unknown"))

    def by_letters(low: Column, letters: Column, beyond: Column) -> Column:
        # ASCII letters are all Latin, so where no other character is only one of both, letters and Latin ones are equally many
        latin = F.when(beyond.rlike(_LETTER_OR_LATIN), count_class(low, r"\p{IsLatin}a-z")).otherwise(letters)
        return let(latin, lambda latin: F.when(latin * 10 < letters * 7, "other").when(count_letters(beyond, VIETNAMESE_LETTERS) * 20 >= latin, "vi").otherwise(by_words(low)))

    def of(low: Column) -> Column:
        # each scan of the text is done once, and only where the ones before have not decided
        beyond = F.regexp_replace(low, r"[\x00-\x7f]+", "")
        return let(count_class(low, r"\p{L}"), lambda letters: F.when(letters < 20, "unknown").otherwise(let(beyond, lambda beyond: by_letters(low, letters, beyond))))

    return let(folded_nfc(c), of)


def strip_think(c: Column) -> Column:
    return collapse_ends(F.regexp_replace(c, r"(?is)<think>.*?(</think>|$(?![\r\n]))", ""))


def collapse_ends(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, f"^{SPACE}", ""), f"{SPACE}$", "")


def extract_code(c: Column) -> Column:
    """Fenced Python blocks, joined by an empty line; without any, the whole text."""
    blocks = F.regexp_extract_all(c, F.lit(r"(?is)```(?:python|py)?[ \t]*\n(.*?)```"), F.lit(1))
    return F.when(F.size(blocks) > 0, F.array_join(blocks, "\n\n")).otherwise(c)


def eval_form(c: Column) -> Column:
    """What exact and contained answers are compared in."""
    return strip(normalize(c), " .!?\"")


def normalize_answer(c: Column) -> Column:
    """Normalised, without separators between a digit and a group of three."""
    return F.regexp_replace(normalize(c), r"(?<=\d)[.,\s](?=\d{3}(?!\d))", "")


def plain_number(c: Column) -> Column:
    """A decimal number in one spelling: a point, no zeros around it that say nothing, no minus before zero. Exact at any length."""
    whole = F.regexp_replace(F.replace(c, F.lit(","), F.lit(".")), r"^(-?)0+(?=\d)", "$1")
    return F.regexp_replace(F.regexp_replace(whole, r"(\.\d*?)0+$|\.$", "$1"), r"\.$|^-(?=0$)", "")


def answer_numbers(c: Column) -> Column:
    """Numbers that stand alone, in the spelling of plain_number()."""
    found = F.regexp_extract_all(normalize_answer(c), F.lit(r"(?<![\p{L}\p{N}_.,])-?\d+(?:[.,]\d+)?"), F.lit(0))
    return F.transform(found, plain_number)


def answer_matches(c: Column, expected: Column) -> Column:
    """Every expected item is in the answer: a number by value, a text as part of it."""
    numbers, text = answer_numbers(c), normalize_answer(c)

    def there(item):
        wanted = normalize_answer(item)
        return F.when(wanted.rlike(r"^-?\d+([.,]\d+)?$"), F.array_contains(numbers, plain_number(wanted))).otherwise(F.contains(text, wanted))

    return F.forall(expected, there)


def has_secret(c: Column) -> Column:
    return c.rlike(SECRET)


def has_shell_secret(c: Column) -> Column:
    return c.rlike(SECRET_SHELL)


def integers(c: Column) -> Column:
    """Runs of digits as whole numbers; null for one beyond 64 bits."""
    return F.transform(F.regexp_extract_all(c, F.lit(r"\d+"), F.lit(0)), lambda n: n.try_cast("bigint"))


def slug(c: Column) -> Column:
    return strip(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "-")


