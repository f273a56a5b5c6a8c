"""Word lists, patterns and limits of the document filter. Another domain supplies its own ``Lexicon``."""

from __future__ import annotations

from dataclasses import dataclass

# fixed values: phrases, terms, URL parts, patterns and limits that decide what the filter keeps
BOILERPLATE = (
    "privacy policy", "cookie policy", "terms of use", "terms of service",
    "terms and conditions", "all rights reserved", "copyright ©",
    "subscribe to our newsletter", "sign up for our newsletter",
    "shopping cart", "add to cart", "buy now", "free shipping",
    "skip to content", "skip to main", "back to top", "click here to",
    "we use cookies", "this website uses cookies", "accept cookies",
    "share on facebook", "share on twitter", "follow us on",
    "latest news", "trending stories", "breaking news", "editorial",
    "opinion piece", "op-ed", "advertisement", "sponsored content",
    "leave a comment", "comments section", "related articles",
    "reporter", "correspondent", "journalism", "newsroom",
)
KEYWORDS = (
    "plaintiff", "defendant", "appellant", "appellee", "respondent", "petitioner",
    "writ", "habeas corpus", "certiorari", "injunction", "mandamus",
    "affidavit", "testimony", "deposition", "subpoena", "pleading", "motion to",
    "pursuant to", "hereby ordered", "it is ordered", "court finds", "court holds",
    "decree", "adjudicated", "remanded", "reversed", "affirmed", "vacated",
    "dismissed", "sustained", "overruled",
    "statute", "codified", "legislature", "constitutionality", "unconstitutional",
    "docket", "jurisdiction", "venue", "standing",
    "verdict", "acquittal", "conviction", "sentencing", "indictment",
    "v.", "vs.", "u.s.c.", "c.f.r.", "f.2d", "f.3d", "s.ct.",
)
NEWS_URLS = (
    "/news/", "/blog/", "/article/", "/story/", "/opinion/", "/editorial/",
    "nytimes.com", "cnn.com", "theguardian.com", "washingtonpost.com",
    "forbes.com", "bbc.com", "reuters.com", "apnews.com", "nbcnews.com",
    "foxnews.com", "usatoday.com", "huffpost.com", "politico.com",
    "buzzfeed.com", "vice.com", "medium.com",
)
#: pattern, whether letter case is ignored, and a part that every match has: it is sought first, as that is cheaper. Where case
#: is ignored it is in lower case and has no letter that other letters fold to.
CITATIONS = (
    (r"v\.\s+[A-Z]", True, "v."),
    (r"§\s*\d+", False, "§"),
    (r"Section\s+\d+", True, "ect"),
    (r"\d+\s+U\.S\.C\.", True, ".c."),
    (r"Article\s+[IVX]+", True, "art"),
    (r"No\.\s+\d+", False, "No."),
    (r"\bId\.", True, "d."),
    (r"Ct\.\s+App\.", True, "ct."),
    (r"\d+\s+F\.\d+d\s+\d+", False, "F."),
    (r"\d+\s+S\.Ct\.\s+\d+", False, "S.Ct."),
    (r"\d+\s+L\.Ed\.\s*\d*", False, "L.Ed."),
    (r"C\.F\.R\.\s*§?\s*\d+", False, "C.F.R."),
    (r"Pub\.\s*L\.\s*No\.", True, "pub."),
    (r"Stat\.\s+\d+", False, "Stat."),
)
SCORE_NAMES = ("Not legal", "Marginal", "Low", "Moderate", "High", "Exceptional")


def java_pattern(pattern: str, ignore_case: bool) -> str:
    """With Unicode classes; white space includes the four separators U+001C to U+001F."""
    return ("(?iU)" if ignore_case else "(?U)") + pattern.replace(r"\s", r"[\s\x1c-\x1f]")


SPACE_SQL = r"[\s\x0b\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"


def sql_pattern(pattern: str, ignore_case: bool) -> str:
    """The same for RE2, whose classes are ASCII."""
    spelled = pattern.replace(r"\s", SPACE_SQL).replace(r"\d", r"\p{Nd}").replace(r"\b", r"(?:^|[^\p{L}\p{N}\p{M}_])")
    return ("(?i)" if ignore_case else "") + spelled


@dataclass(frozen=True)
class Lexicon:
    boilerplate: tuple[str, ...] = BOILERPLATE
    keywords: tuple[str, ...] = KEYWORDS
    news_urls: tuple[str, ...] = NEWS_URLS
    citations: tuple[tuple[str, bool, str], ...] = CITATIONS
    min_keywords: int = 2
    boilerplate_chars: int = 1000
    keyword_chars: int = 5000
    citation_chars: int = 8000
    min_chars: int = 500
    max_chars: int = 50_000


STAGE1 = Lexicon()
ANNOTATION = Lexicon(min_chars=1000)
