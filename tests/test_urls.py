from pyspark.sql import functions as F

from ledgerloom.functions import urls as U
from ledgerloom.functions.html import main_text

X = F.col("x")


def test_company_profile_url(values):
    base = "https://www.ycombinator.com/companies"
    assert values(["acme", "", None], U.company_profile_url(X, F.lit("https://a.example"))) == [
        f"{base}/acme", "https://a.example", "https://a.example"]
    assert values([None], U.company_profile_url(X, F.lit(""))) == [base]


def test_repo_url(values):
    rows = ["see (https://github.com/a-b/c.d.git).", "http://github.com/x/y, z", "github.com/x/y", None,
            "https://github.com/o/r/tree and https://github.com/p/q"]
    assert values(rows, U.repo_url(X)) == [
        "https://github.com/a-b/c.d.git", "http://github.com/x/y", None, None, "https://github.com/o/r"]


def test_owner_repo(values):
    rows = ["https://github.com/a-b/c.d.git", "https://github.com/a/b", "https://example.com/a/b", None]
    found = values(rows, U.owner_repo(X))
    assert [tuple(f) if f else None for f in found] == [("a-b", "c.d"), ("a", "b"), None, None]


def test_paper_short_id(values):
    rows = ["http://arxiv.org/abs/2607.14585v1", "http://arxiv.org/abs/2607.14585v12/", "http://arxiv.org/abs/2607.14585"]
    assert values(rows, U.paper_short_id(X)) == ["2607.14585"] * 3


def test_canonical_url(values):
    rows = ["HTTP://Example.COM", "https://a.b:443/X?q=1#t", "http://a.b:80?q=1", "http://a.b:8080/", " http://a.b/p ", "n/a", None]
    assert values(rows, U.canonical_url(X)) == [
        "http://example.com/", "https://a.b/X?q=1#t", "http://a.b/?q=1", "http://a.b:8080/", "http://a.b/p", "n/a", None]


def test_dedup_key_drops_scheme_fragment_and_tracking(values):
    rows = ["https://A.b/x?utm_source=f&y=1#t", "http://a.b/x?y=1&utm_a=2", "http://a.b/x?y=1", "http://a.b/x?utm_a=1&utm_b=2"]
    assert values(rows, U.dedup_key(X)) == ["a.b/x?y=1", "a.b/x?y=1", "a.b/x?y=1", "a.b/x"]


def test_is_http_url(values):
    rows = ["https://a.b", "HTTP://a.b/x?y", "ftp://a.b", "a.b", "https://", "https://a b", None]
    assert values(rows, U.is_http_url(X)) == [True, True, False, False, False, False, False]


def test_main_text(values):
    html = ("<html><head><title>t</title></head><body><nav>menu</nav><!-- x --><script>a<b</script>"
            "<p>One &amp; two</p>\n<p>three&nbsp;four</p><style>p{}</style></body></html>")
    assert values([html, "<p> </p>", None], main_text(X)) == ["One & two three four", None, None]
