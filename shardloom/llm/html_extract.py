"""Main text of web pages by equivalence-class template deduction.

A token is an opening or closing container tag with its path.  Tokens of one
host that have the same occurrence vector (how often each page holds them) form
an equivalence class; the vector is folded into one number by an aggregation
that combines before it shuffles, so no host's pages are gathered anywhere.
Classes with enough support whose tokens come once a page and more than one at
a time are valid, and nest by path into the host's template.  The main slot is
the deepest valid section-like container that leaves out no article text on any
page that has it; its blocks outside of menus, adverts and the like are the text
of the page.  Article text is what stands in article and main elements, if that
is most of the page's text, or else all of it.  Lists, tables, quotes and figures
are parts of a text and never its slot.  A page that lacks its host's main slot
is judged by its own containers.

Defined results: a null or empty html gives an empty text; a null or odd url
belongs to a host of its own name; repeated rows are treated one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small, small_batches, tidy, written

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>""", re.S)
NAME = re.compile(r"""(?:class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)

# Element names, by how they act on the text.
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "br", "img"}
CONTAINERS = {"html", "head", "body", "main", "article", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "dl", "table", "figure", "blockquote", "center", "fieldset", "details", "dialog", "menu"}
RAW = {"script", "style", "textarea", "noscript", "iframe", "template", "svg", "math", "object", "select", "button", "title", "noembed", "noframes"}
APART = {"head", "nav", "footer", "aside", "form", "menu", "dialog", "fieldset"}
#: Words in a class, id or role that name what is not the article.
APART_NAME = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|sidebar\w*|side|footer\w*|breadcrumb\w*|comment\w*|respond|disqus|cookie\w*|consent|notice\w*|popup|modal|newsletter|subscribe|share\w*|social\w*|related|widget\w*|toolbar|login|search)(?:$|[\s_-])", re.I)
HEADER_NAME = re.compile(r"(?:^|[\s_-])(?:header|masthead)(?:$|[\s_-])", re.I)
#: Containers that can be the main slot, and those of them that name the article.
SLOTS, ARTICLES = {"html", "body", "main", "article", "section", "div", "center"}, {"main", "article"}
#: The share of the text that article elements hold, and a class's share of the pages, from which they count.
SHARE, SUPPORT = 0.5, 0.5


def _element(token: str) -> str:
    return token.partition(".")[0]


class Page:
    """Blocks (path, apart, text) in page order, and how often each container token comes."""

    def __init__(self, source: str | None):
        self.blocks: list[tuple[tuple[str, ...], bool, str]] = []
        self.tokens: Counter = Counter()
        stack: list[tuple[str, str, bool]] = []  # element, its token, apart
        text: list[str] = []
        at, source = 0, source or ""

        def flush() -> None:
            if text:
                words = entities.unescape("".join(text)).split()
                text.clear()
                if words:
                    self.blocks.append((tuple(s[1] for s in stack), bool(stack) and stack[-1][2], " ".join(words)))

        while True:
            m = TAG.search(source, at)
            if m is None:
                text.append(source[at:])
                break
            text.append(source[at : m.start()])
            at = m.end()
            name = (m[2] or m[5] or "").lower()
            if not name or name in INLINE:
                if name == "br":
                    text.append(" ")
                continue
            closing = bool(m[1] or m[4])
            if name in RAW and not closing:
                if not (m[3] or m[6] or "").endswith("/"):
                    end = re.compile(rf"</{re.escape(name)}\b[^>]*>", re.I).search(source, at)
                    at = end.end() if end else len(source) if name in ("script", "style") else at
                if name not in ("select", "button", "svg", "math", "object"):
                    flush()
                continue
            flush()
            if name not in CONTAINERS:
                continue
            if closing:
                for k in range(len(stack) - 1, -1, -1):
                    if stack[k][0] == name:
                        self.tokens["/" + ">".join(s[1] for s in stack[: k + 1])] += 1
                        del stack[k:]
                        break
                continue
            names = " ".join(x.strip("\"'") for x in NAME.findall(m[3] or m[6] or ""))
            inside = any(s[0] in ("article", "main") for s in stack)
            apart = (bool(stack) and stack[-1][2]) or name in APART or (name == "header" and not inside)
            apart = apart or (name not in ("html", "body", "main", "article") and bool(APART_NAME.search(names) or (HEADER_NAME.search(names) and not inside)))
            token = f"{name}.{'.'.join(names.split())}" if names else name
            stack.append((name, re.sub(r"\d+", "0", token), apart))
            self.tokens[">".join(s[1] for s in stack)] += 1
        flush()

    def weights(self) -> Counter:
        """Characters of article text, for every container path."""
        held = [(path, len(text)) for path, apart, text in self.blocks if not apart]
        inside = [(path, n) for path, n in held if any(_element(token) in ARTICLES for token in path)]
        if sum(n for _, n in inside) >= SHARE * sum(n for _, n in held):
            held = inside
        found: Counter = Counter()
        for path, n in held:
            for k in range(len(path) + 1):
                found[">".join(path[:k])] += n
        return found

    def own_slot(self) -> str:
        found = self.weights()
        whole = [p for p, n in found.items() if n == found[""] and self.tokens[p] == 1 and _element(p.rpartition(">")[2]) in SLOTS]
        return max(whole, key=lambda p: (p.count(">"), p), default="")

    def text(self, slot: str) -> str:
        if not slot or not self.tokens.get(slot):
            slot = self.own_slot()
        want = tuple(slot.split(">")) if slot else ()
        return "\n".join(text for path, apart, text in self.blocks if not apart and path[: len(want)] == want)


def _hosted(pages: DataFrame) -> DataFrame:
    small_batches(pages.sparkSession)
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), host.alias("host"), F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))


def templates(pages: DataFrame) -> DataFrame:
    """Valid template tokens of every host: host, path, class (folded occurrence vector), class_size, pages, chars, missed (article text outside of it on its pages), and parent path."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row, host, source in zip(batch["row"], batch["host"], batch["html"]):
                page = Page(source)
                weights = page.weights()
                out.append((row, host, "", 1, weights[""], 0))
                out += [(row, host, token, n, weights[token], weights[""] - weights[token]) for token, n in page.tokens.items()]
            yield pd.DataFrame(out, columns=["row", "host", "token", "n", "chars", "missed"])

    seen = _hosted(pages).withColumn("row", F.monotonically_increasing_id()).mapInPandas(tidy(scan), "row long, host string, token string, n int, chars long, missed long")
    vectors = seen.groupBy("host", "token").agg(F.bit_xor(F.xxhash64("row", "n")).alias("class"), F.max("n").alias("most"), F.count("*").alias("pages"), F.sum("chars").alias("chars"), F.sum("missed").alias("missed"))
    vectors = written(vectors, "vectors")
    whole = vectors.where("token = ''").select("host", F.col("pages").alias("host_pages"), F.col("chars").alias("host_chars"))
    sizes = vectors.where("token <> ''").groupBy("host", "class").agg(F.count("*").alias("class_size"))
    valid = vectors.where("token <> '' and most = 1").join(sizes.where("class_size > 1"), ["host", "class"]).join(whole, "host").where(F.col("pages") >= SUPPORT * F.col("host_pages"))
    path = F.ltrim("token", F.lit("/"))
    return valid.select("host", "token", path.alias("path"), "class", "class_size", "pages", "chars", "missed", "host_chars", F.regexp_replace(path, "(^|>)[^>]*$", "").alias("parent"))


def main_slots(pages: DataFrame) -> DataFrame:
    """host -> path of its main slot."""
    held = templates(pages).where((F.substring("token", 1, 1) != "/") & (F.col("missed") == 0) & (F.col("chars") > 0) & F.regexp_extract("path", r"([^>.]*)(?:\.[^>]*)?$", 1).isin(*sorted(SLOTS)))
    depth = F.size(F.split("path", ">"))
    return held.groupBy("host").agg(F.max(F.struct(depth.alias("depth"), "chars", "path")).alias("best")).select("host", F.col("best.path").alias("slot"))


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars for every row of pages."""
    slots = small(written(main_slots(pages), "slots"))
    held = _hosted(pages).join(slots, "host", "left")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [Page(source).text(slot or "") for source, slot in zip(batch["html"], batch["slot"].where(batch["slot"].notna(), ""))]
            frame = pd.DataFrame({"page_id": batch["page_id"].astype("Int64"), "url": batch["url"], "text": texts})
            yield frame.assign(n_chars=frame["text"].str.len().astype("int64"))

    return held.select("page_id", "url", "html", "slot").mapInPandas(tidy(cut), "page_id long, url string, text string, n_chars long")
