import pytest
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions import text as T

X = F.col("x")


def test_strip_removes_unicode_space_on_both_ends(values):
    assert values(["  a b \n", "  a\x1c", None, " \t "], T.strip(X)) == ["a b", "a", None, ""]


def test_blank(values):
    assert values([None, "", " \n", "a"], T.is_blank(X)) == [True, True, True, False]


def test_pricing_rules_apply_in_order(values):
    rows = ["A FREE tool", "freemium and free", "Enterprise, free trial", "paid", "a subscription", "pricing plan",
            "carefree prepaid", "", None]
    assert values(rows, T.pricing_label(X)) == [
        "FREE", "FREEMIUM", "ENTERPRISE", "PAID", "PAID", "PAID", None, None, None]


def test_role_families(values):
    rows = ["Senior Software Engineer", "AI Research Scientist", "Head of Sales", "Research Engineer", "PM for X", "pm",
            "hr lead", "Chairs", "General Counsel", "Something Unusual Nobody Would Guess", None]
    assert values(rows, T.role_family(X)) == [
        "Engineering", "Research", "Sales", "Engineering", "Product", None, "People", None, "Legal", None, None]


def test_remote_flag_is_unknown_without_location(values):
    rows = ["Remote", "San Francisco (Remote)", "remotely", "", None]
    assert values(rows, T.remote_flag(X)) == [True, True, False, None, None]


def test_explicit_remote_flag_wins(values):
    assert values(["Remote", "Berlin"], T.remote_flag(X, F.lit(False))) == [False, False]


def test_relevance_uses_word_boundaries(values):
    rows = ["Nvidia stock dips again", "the chair was empty in the rain", "OpenAI announces GPT-5.6", "Why AI matters",
            "machine-learning", "the ml model", "html model", "éai", "aié", "LLMs.", "Generative", ""]
    assert values(rows, T.is_relevant(X, F.lit(None).cast("string"))) == [
        False, False, True, True, True, True, False, False, False, True, False, False]


def test_relevance_reads_the_summary_too(values):
    assert values(["a chatbot", None], T.is_relevant(F.lit("Title"), X)) == [True, False]


def test_own_patterns(values):
    assert values(["Big Cats", "cathedral", "dog"], T.mentions(X, [r"\bcats\b", r"d[o0]g", "thed"])) == [True, True, True]
    assert values(["a-b", "ab"], T.mentions(X, [r"a\-b"])) == [True, False]


@pytest.mark.parametrize("raw,norm", [
    ("OpenAI, Inc.", "openai"), ("huggingface.co", "huggingface"), ("X.AI", "x"), ("W&B", "w b"), ("Scale.ai", "scale"),
    ("  Black-Forest_Labs/Co. ", "black forest labs"), (None, ""), ("", ""), ("Incorporated Ltd", ""), ("Cohere", "cohere"),
    ("Repl.it", "repl it"),
])
def test_normalize_name(values, raw, norm):
    assert values([raw], T.normalize_name(X)) == [norm]


def test_chunk_keeps_short_text_and_null(values):
    assert values(["This is a short article.", None, "  a  "], T.chunk_text(X)) == ["This is a short article.", "", "a"]


def test_chunk_cuts_at_paragraph(values):
    text = "First paragraph with important facts. " * 20 + "\n\n" + "Second paragraph. " * 200
    [chunk] = values([text], T.chunk_text(X, 1000))
    assert "Second" not in chunk and chunk.endswith("facts.")


def test_chunk_ignores_an_early_paragraph_end(values):
    text = "Intro.\n\n" + "word " * 40 + "end. " + "tail " * 100
    [chunk] = values([text], T.chunk_text(X, 300))
    assert chunk.endswith("end.")


def test_chunk_cuts_at_sentence_then_hard(values):
    sentences, letters = "Sentence one is here. Sentence two is here. " * 50, "a" * 10000
    assert values([sentences], T.chunk_text(X, 100))[0][-1] == "."
    assert values([letters], T.chunk_text(X, 500)) == ["a" * 500]


def test_chunk_counts_whole_characters(values):
    assert values(["😀" * 50], T.chunk_text(X, 10)) == ["😀" * 10]


def test_prompt(values):
    [prompt] = values(["body"], T.build_prompt(X, "SCHEMA"))
    assert prompt == fv.PROMPT_HEAD + "SCHEMA" + fv.PROMPT_TEXT_MARK + "body"


def test_truncate_cell(values):
    long, exact = values(["x" * 6000, "y" * 5000], T.truncate_cell(X))
    assert long == "x" * 5000 + "... [truncated]" and exact == "y" * 5000
    assert values([None], T.truncate_cell(X)) == [""]


def test_source_label(values):
    assert values(["Scale AI"], T.source_label(X, F.lit("greenhouse"))) == ["Scale AI (Greenhouse)"]


def test_first_non_empty(values):
    assert values(["", None, "a"], T.first_non_empty(X, F.lit(""), F.lit("z"))) == ["z", "z", "a"]
