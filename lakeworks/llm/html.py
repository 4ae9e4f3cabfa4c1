"""Main text of web pages by templates deduced from pages of the same host.

A token is an element at its place: the path of elements from the root, each with its
classes. Its occurrence vector says how often it stands in each page of the host. Tokens
with the same vector form an equivalence class. A class is valid if it is found in
enough of the host's pages and its tokens stand once in each of those pages; such classes
nest by their paths and are the template, and what lies between their tokens are the
slots. The slot of the article is the element of a valid class that is marked as the
article or, without one, the innermost one that holds nearly all of the words outside
links that differ between pages. All that is in it is extracted but menus, forms,
notices, adverts and comments and, where no element is marked, the wording of the
template: text of a token that is the same in all pages that have it, if those differ and
are at least half of the host's. A page that does not have its host's article slot is
treated as a template of its own.

Vectors are never put together: a token's vector is represented by the number of pages,
the number of occurrences and their sum weighted with a hash of the page, and its text by
the least and greatest hash. These are plain aggregates, so a host with a third of all
pages is counted in every task. The number of frequent tokens of a host is bounded by the
size of its pages. A path has at most ``DEPTH`` elements; what is deeper belongs to the
last of them but is still left out by its own elements' kind.

Defined cases: a null or empty page has no text; a page without a host is compared with
the other such pages; equal rows get equal results; markup that is never closed ends
with what encloses it.
"""

from __future__ import annotations

import html as references
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import unused, without

SUPPORT = 0.1
MOST_WORDS = 0.9
# Wording of the template: in at least this many pages of the host, and in this share of them.
LEAST_PAGES = 3
STATIC_SHARE = 0.5
# Elements below this depth belong to their ancestor's token.
DEPTH = 24

# --- fixed values: elements and names of what is no main text ---

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript template svg math".split())
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
CLOSES_P = BLOCKS - frozenset("body html option legend summary td th tr tbody thead tfoot dd dt li".split()) | {"li"}
CLOSED_BY_SIBLING = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "tr": ("tr td th", "table"),
                     "td": ("td th", "tr table"), "th": ("td th", "tr table"), "option": ("option", "select")}
NOT_TEXT = frozenset("head nav footer aside form button select datalist dialog menu search object canvas audio video map".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
NAMES = frozenset(
    "nav navbar navigation menu menus footer sidebar sidebars aside ad ads advert adverts advertisement advertising banner promo promotion "
    "sponsor sponsored cookie cookies consent gdpr notice notices popup modal overlay newsletter subscribe subscription signup login search "
    "share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments disqus reply replies widget widgets "
    "toolbar skip copyright".split())
OUTSIDE_NAMES = frozenset("header masthead topbar".split())
COMMENT_NAMES = frozenset("comment comments reply replies".split())
# In an article these say what an element is only at the end of its name.
LAST_NAMES = frozenset("notice notices banner".split())
SECTIONS = frozenset("html body div section center td main article".split())

TAG = re.compile(r"""<!--.*?(?:--!?>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"<]*"|'[^'<]*')*+)>|</?[a-zA-Z][^>]*>""", re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role|itemprop|aria-hidden|hidden)\b(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


def _element(tag: str, attributes: str, in_main: bool) -> str:
    """One element of a path. It begins with ``!`` if its content is no main text, with ``*`` if it is marked as main."""
    values = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    names = re.sub(r"[0-9]+", "0", f"{values.get('class', '')} {values.get('id', '')}").split()
    named = [[p.lower() for p in NAME_PART.findall(n)] for n in names]
    parts = {p for own in named for p in own if not in_main or p not in LAST_NAMES or p == own[-1]}
    role = values.get("role", "").lower()
    hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true"
    frame = tag in ("html", "body", "main", "article")
    out = (tag in NOT_TEXT or role in ROLES or hidden or not frame and bool(parts & NAMES) or tag == "article" and bool(parts & COMMENT_NAMES)
           or not in_main and not frame and (tag == "header" or bool(parts & OUTSIDE_NAMES)))
    main = tag in ("article", "main") or role == "main" or values.get("itemprop", "") == "articleBody"
    return ("!" if out else "*" if main else "") + tag + "".join(sorted({f".{n}" for n in names})[:4])


class Page:
    """Text pieces of a page in order: ``(path, block number, inside a link, no main text, text)``."""

    def __init__(self, source: str):
        self.tokens: dict[tuple[str, ...], int] = {}
        self.pieces: list[tuple[tuple[str, ...], int, bool, bool, str]] = []
        tags: list[str] = []
        path: list[str] = []
        block, at, links, outs, mains = 0, 0, 0, 0, 0
        fixed: tuple[str, ...] = ()

        def close(depth: int) -> None:
            nonlocal fixed, links, block, outs, mains
            for t, p in zip(tags[depth:], path[depth:]):
                links -= t == "a"
                block += t in BLOCKS
                outs -= p[0] == "!"
                mains -= p[0] == "*"
            del tags[depth:], path[depth:]
            fixed = tuple(path[:DEPTH])

        def text(raw: str) -> None:
            if raw and not raw.isspace():
                self.pieces.append((fixed, block, links > 0, outs > 0, references.unescape(raw)))
            elif raw:
                self.pieces.append((fixed, block, links > 0, outs > 0, " "))

        end = len(source)
        while at < end:
            found = TAG.search(source, at)
            if not found:
                text(source[at:])
                break
            text(source[at:found.start()])
            at = found.end()
            if found[2] is None:
                continue
            tag = found[2].lower()
            if found[1]:
                if tag in tags:
                    close(len(tags) - 1 - tags[::-1].index(tag))
                elif tag == "p":
                    block += 1
                continue
            if tag in RAW:
                stop = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(source, at)
                at = stop.end() if stop else end
                continue
            if tag in BLOCKS:
                block += 1
                if tag in CLOSES_P and "p" in tags:
                    close(len(tags) - 1 - tags[::-1].index("p"))
                if tag == "body" and "head" in tags:
                    close(tags.index("head"))
            if tag in CLOSED_BY_SIBLING:
                own, until = (set(x.split()) for x in CLOSED_BY_SIBLING[tag])
                for depth in range(len(tags) - 1, -1, -1):
                    if tags[depth] in until:
                        break
                    if tags[depth] in own:
                        close(depth)
                        break
            if tag in VOID:
                if tag == "br":
                    self.pieces.append((fixed, block, links > 0, outs > 0, " "))
                continue
            if found[3].endswith("/") and tag not in BLOCKS and tag != "a":
                continue
            tags.append(tag)
            path.append(_element(tag, found[3], mains > 0))
            links += tag == "a"
            outs += path[-1][0] == "!"
            mains += path[-1][0] == "*"
            if len(path) <= DEPTH:
                fixed = tuple(path)
                self.tokens[fixed] = self.tokens.get(fixed, 0) + 1

    def words(self) -> dict[tuple[str, ...], tuple[int, int]]:
        """By path: words outside links and outside what is no main text, and a hash of them."""
        out: dict[tuple[str, ...], tuple[int, int]] = {}
        for path, _, link, no_text, piece in self.pieces:
            if not link and not no_text and (words := piece.split()):
                n, value = out.get(path, (0, 0))
                out[path] = n + len(words), zlib.crc32(" ".join(words).encode("utf-8", "replace"), value)
        return out

    def extract(self, slots: list[tuple[str, ...]], static: frozenset[tuple[str, ...]] = frozenset()) -> str:
        """Text of the slots but for the wording of the template, one line per block."""
        blocks: dict[int, list[str]] = {}
        inside: dict[tuple[str, ...], bool] = {}
        for path, block, _, no_text, piece in self.pieces:
            keep = inside.get(path)
            if keep is None:
                keep = inside[path] = path not in static and any(path[:len(s)] == s for s in slots)
            if keep and not no_text:
                blocks.setdefault(block, []).append(piece)
        lines = (" ".join("".join(b).split()) for b in blocks.values())
        return "\n".join(line for line in lines if line)


def article_slots(template: dict[tuple[str, ...], float], words: dict[tuple[str, ...], float]) -> list[tuple[str, ...]]:
    """The article's slots among the tokens of valid classes, each given with how common it is."""
    open_ = {p: n for p, n in template.items() if not any(e[0] == "!" for e in p)}
    marked = [p for p in open_ if p[-1][0] == "*"]
    if marked:
        # Outermost marked elements; a main element around an article gives way to it.
        outer = [p for p in marked if not any(q != p and p[:len(q)] == q for q in marked)]
        out = []
        for p in outer:
            inner = [q for q in marked if q != p and q[:len(p)] == p and q[-1].startswith("*article")]
            out += [q for q in inner if not any(r != q and q[:len(r)] == r for r in inner)] or [p]
        return sorted(out)
    total = sum(words.values())
    inside = {p: sum(n for q, n in words.items() if q[:len(p)] == p) for p in open_}
    good = [p for p in open_ if total and inside[p] >= MOST_WORDS * total]
    if not good:
        return []
    best = max(good, key=lambda p: (len(p), inside[p], p))
    # A paragraph, list or heading is part of a text, so the slot is what encloses it.
    while len(best) > 1 and best[:-1] in open_ and best[-1].split(".")[0] not in SECTIONS:
        best = best[:-1]
    return [best]


def _host(url: str | None) -> str:
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    return re.match(r"[^/?#]*", rest)[0].lower()


_SEPARATOR = "\x01"


def token_counts(pages: DataFrame, url: str, html: str) -> DataFrame:
    """``host, path``: pages with the token, its occurrences, their sum weighted by page, words, and whether pages and texts differ.

    Pages are summed up in each task.
    """
    flush = 200_000
    names = ["pages", "n", "vector", "words", "page_least", "page_most", "text_least", "text_most"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[str, str], list[int]] = {}

        def out() -> pa.RecordBatch:
            keys = list(sums)
            columns = list(zip(*sums.values())) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                               *(pa.array(c, pa.int64()) for c in columns)], ["host", "path", *names])

        for batch in batches:
            for address, source in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                page, host = Page(source or ""), _host(address)
                name, content = zlib.crc32(f"{address}\n{source}".encode()), zlib.crc32((source or "").encode())
                words = page.words()
                for path, n in [((), 1), *page.tokens.items()]:
                    n_words, text = words.get(path, (0, 0))
                    row = sums.get(key := (host, _SEPARATOR.join(path)))
                    if row is None:
                        sums[key] = [1, n, n * name, n_words, content, content, text, text]
                    else:
                        row[:] = (row[0] + 1, row[1] + n, row[2] + n * name, row[3] + n_words, min(row[4], content), max(row[5], content),
                                  min(row[6], text), max(row[7], text))
                if len(sums) > flush:
                    yield out()
                    sums.clear()
        yield out()

    rows = pages.select(url, html).mapInArrow(run, "host string, path string, " + ", ".join(f"{n} long" for n in names))
    return rows.groupBy("host", "path").agg(
        F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.sum(F.col("vector").cast("decimal(38,0)")).alias("vector"), F.sum("words").alias("words"),
        (F.min("page_least") != F.max("page_most")).alias("pages_differ"), (F.min("text_least") != F.max("text_most")).alias("texts_differ"))


def templates(counts: DataFrame) -> DataFrame:
    """``host, slots, static``: the article's slots of every host, from its valid equivalence classes, and the tokens with wording of the template."""
    whole = counts.where("path = ''").select("host", F.col("pages").alias("host_pages"))
    frequent = counts.where("path != ''").join(whole, "host").where(F.col("pages") >= F.col("host_pages") * SUPPORT)
    is_static = (F.col("pages") >= LEAST_PAGES) & (F.col("pages") >= F.col("host_pages") * STATIC_SHARE) & F.col("pages_differ") & ~F.col("texts_differ")
    classes = frequent.groupBy("host", "pages", "n", "vector").agg(F.collect_list(F.struct("path", "words", is_static.alias("static"))).alias("tokens"))
    by_host = classes.groupBy("host").agg(F.collect_list(F.struct("pages", "n", "tokens")).alias("classes"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots, static = [], []
            for classes_ in batch.column(1).to_pylist():
                every = {tuple(t["path"].split(_SEPARATOR)): (c, t) for c in classes_ for t in c["tokens"]}
                valid = {p: float(c["pages"]) for p, (c, _) in every.items() if c["n"] == c["pages"]}
                # Valid classes nest: a token counts if what encloses it is in the template too.
                template: dict[tuple[str, ...], float] = {}
                for p in sorted(valid, key=len):
                    if len(p) == 1 or p[:-1] in template:
                        template[p] = valid[p]
                words = {p: float(t["words"]) for p, (_, t) in every.items() if t["words"] and not t["static"]}
                found = article_slots(template, words)
                slots.append([_SEPARATOR.join(s) for s in found])
                # What is marked as the article is kept whole.
                static.append([t["path"] for _, t in every.values() if t["static"] and t["words"] and not any(s[-1][0] == "*" for s in found)])
            paths = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(slots, paths), pa.array(static, paths)], ["host", "slots", "static"])

    return by_host.mapInArrow(run, "host string, slots array<string>, static array<string>")


def main_text(source: str | None, slots: list[str] | None, static: list[str] | None = None) -> str:
    """Text of a page by its host's template or, where it has none of its slots, by its own."""
    page = Page(source or "")
    wanted = [t for s in slots or () if (t := tuple(s.split(_SEPARATOR))) in page.tokens]
    if not wanted:
        # Without a marked element that stands once, all marked ones; else the page is its own template.
        # Where nothing holds most of the words, all of the page that may be text is the slot.
        words = {p: n for p, (n, _) in page.words().items()}
        return page.extract(article_slots({p: 1.0 for p, n in page.tokens.items() if n == 1 or p[-1][0] == "*"}, words) or [()])
    return page.extract(wanted, frozenset(tuple(s.split(_SEPARATOR)) for s in static or ()))


def extract(pages: DataFrame, url: str = "url", html: str = "html", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``pages`` without the html, with the main text and its length in code points; columns of these names are replaced."""
    found = templates(token_counts(pages, url, html))
    kept = without(pages, html, text, n_chars)
    host, slots, static, source = (unused(pages, c) for c in ("_host", "_slots", "_static", "_html"))
    after = F.when(F.contains(F.col(url), F.lit("://")), F.substr(F.col(url), F.length(F.substring_index(F.col(url), "://", 1)) + 4))
    own = F.coalesce(F.lower(F.regexp_extract(after, r"^([^/?#]*)", 1)), F.lit(""))
    rows = pages.select(*kept, F.col(html).alias(source), own.alias(host))
    joined = rows.join(found.select(F.col("host").alias(host), F.col("slots").alias(slots), F.col("static").alias(static)), host, "left").select(
        *kept, source, slots, static)
    fields = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(kept)
        for batch in batches:
            texts = [main_text(*page) for page in zip(*(batch.column(n + i).to_pylist() for i in range(3)))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             [*kept, text, n_chars])

    return joined.mapInArrow(run, f"{fields}{', ' if kept else ''}`{text}` string, `{n_chars}` bigint")
