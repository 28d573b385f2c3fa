"""Main text of web pages by equivalence-class template deduction.

A page is a list of tokens: its tags, and its pieces of text between tags. Tokens are told apart by their
path of open elements (names, classes and ids without digits), so a word in a menu is not the same token as
that word in an article. Over the pages of one host:

1. Each token's occurrence vector (how often it is on each page) is kept as sums that need no order: pages,
   occurrences, and the exclusive-or of a hash of (page, count). Tokens with equal vectors are an equivalence
   class. Classes of at least two tokens, one of them a tag, on at least SHARE of the pages of a host with
   LEAST_PAGES or more, are candidates.
2. A candidate is valid if it is ordered (its tokens come in the same order on every page, over and over
   where they occur more than once) and nested (its occurrences lie whole in one and the same slot of the
   class around it on every page). Valid classes, each in its parent's slot, are the host's template.
3. What a page has besides the template is in its slots. Text of the slots is kept, but for slots that the
   tags around them mark as something else than the article (menus, headers, footers, asides, adverts,
   forms, scripts, comments and the like), joined block by block. Where a page has an ``article`` element
   (else ``main``) only slots in it are read.

Vectors are added up in each task before they are shuffled, so a host with a third of all pages is a
few rows a token and task; a host's template is bounded by its pages' size, as each token of it is on nearly
all of them. It meets the pages in a join, which Spark broadcasts only where the templates are small enough,
and otherwise splits where a host is hot. Pages are never collected, cut or sampled.

A null or empty html gives an empty text. Pages with a null url, and those of hosts with fewer than
LEAST_PAGES pages, have no template: only the tags decide. Repeated rows are pages like others. Broken
markup (unclosed, unopened or crossing tags, cut references) is read as browsers do, roughly. Extra
columns are ignored; an empty table gives no rows."""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from delivery_lake.llm.common import mix64, modest_batches, written

#: Least share of a host's pages that have a template token, and least pages of a host with a template.
SHARE, LEAST_PAGES = 0.9, 4
#: Entries that a task holds before it hands its sums on.
HELD = 100_000

#: Elements without content, and those that end a block of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav noscript ol optgroup option p pre search section "
    "select summary table tbody tfoot thead title tr ul".split())
#: Elements that are not the article, the words of a class or id that say so, and the roles. Words of the
#: layout may also be on a wrapper around everything ("with-sidebar"): they do not hold for an article
#: element inside, and not behind a word of LAYOUT_PREFIXES.
OTHER = frozenset(
    "aside button canvas dialog footer form frameset head iframe menu nav noscript object script search select style svg template "
    "textarea title".split())
OTHER_WORDS = frozenset("comment comments disqus promo promotion recommended related replies sponsor sponsored teaser".split())
LAYOUT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies footer gdpr login masthead "
    "menu modal nav navbar navigation newsletter notice notices pager pagination popup search share sharing sidebar signup social "
    "subscribe toolbar widget".split())
LAYOUT_PREFIXES = frozenset("has hide no with without".split())
OTHER_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())

#: Elements that leave a head open.
IN_HEAD = frozenset("base html link meta noscript object script style template title".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b[^>]*+>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*+>"
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"""(?:^|[\s"'/])(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_NO_WORD = re.compile(r"[^a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_MASK = (1 << 64) - 1


class Reader:
    """Reads pages as tokens; keeps what it has learned of paths and attributes."""

    def __init__(self):
        self.paths: dict = {}
        self.attributes: dict = {}

    def _signature(self, name: str, rest: str) -> tuple[str, int]:
        """How an element is named in paths, and whether it is marked as something else than the article: 2,
        1 if by its layout only, 0 if not."""
        known = self.attributes.get((name, rest))
        if known is None:
            words, other = [], 2 * (name in OTHER)
            for key, value in _ATTRIBUTE.findall(rest):
                value = value.strip("\"'")
                found = [w for w in _NO_WORD.split(_CAMEL.sub(" ", value).lower()) if w]
                words.append((key.lower(), *found))
                if key.lower() == "role":
                    other = max(other, 2 * (not OTHER_ROLES.isdisjoint(found)))
                elif name not in ("html", "body"):
                    layout = {w for before, w in zip(["", *found], found) if before not in LAYOUT_PREFIXES}
                    other = max(other, 2 * (not OTHER_WORDS.isdisjoint(found)), not LAYOUT_WORDS.isdisjoint(layout))
            known = (f"{name}{sorted(words)}" if words else name, other)
            if len(self.attributes) >= HELD:
                self.attributes.clear()
            self.attributes[name, rest] = known
        return known

    def _path(self, parent: int, signature: str) -> int:
        at = self.paths.get((parent, signature))
        if at is None:
            import xxhash

            at = xxhash.xxh64_intdigest(signature.encode("utf-8", "surrogatepass"), seed=parent)
            if len(self.paths) >= HELD:
                self.paths.clear()
            self.paths[parent, signature] = at
        return at

    def tokens(self, page: str) -> tuple[list[tuple], int]:
        """(token, text or None for a tag, block, zone, mark of something else than the article) for every
        token of a page, and the page's highest zone: 2 within ``article``, 1 within ``main``, 0."""
        import xxhash

        out, stack, opened = [], [("", 0, 0, 0)], Counter()
        block, highest, at = 0, 0, 0

        def pop() -> None:
            opened[stack.pop()[0]] -= 1

        def text(piece: str) -> None:
            _, path, other, zone = stack[-1]
            words = piece.split()
            token = xxhash.xxh64_intdigest(" ".join(words).encode("utf-8", "surrogatepass"), seed=path ^ 4) if words else 0
            out.append((token, piece, block, zone, other))

        for m in _TOKEN.finditer(page):
            if m.start() > at:
                text(page[at:m.start()])
            at = m.end()
            end, name, rest = (m[2], m[3], m[4]) if m[3] else (m[5], m[6], m[7])
            if not name:  # comments, declarations, scripts and styles: one token each, whatever is in them
                if page.startswith(("<!-", "<s", "<S"), m.start()):
                    out.append((self._path(stack[-1][1], f"<{(m[1] or '!').lower()}"), None, block, 0, True))
                continue
            name = name.lower()
            block += name in BLOCK
            if end:
                if opened[name] > 0:
                    while stack[-1][0] != name:
                        pop()
                    out.append((stack[-1][1] ^ 2, None, block, 0, True))
                    pop()
                continue
            if opened["head"] > 0 and name not in IN_HEAD:
                while stack[-1][0] != "head":
                    pop()
                pop()
            if name in BLOCK and opened["p"] > 0:
                while stack[-1][0] != "p":
                    pop()
                pop()
            if name in ("li", "tr", "option", "dt", "dd") and opened[name] > 0:
                k = len(stack) - 1
                while stack[k][0] not in (name, "ul", "ol", "menu", "table", "tbody", "thead", "tfoot", "select", "dl", ""):
                    k -= 1
                if stack[k][0] == name:
                    while len(stack) > k:
                        pop()
            signature, other = self._signature(name, rest)
            _, parent, around, zone = stack[-1]
            path = self._path(parent, signature)
            out.append((path ^ 1, None, block, 0, True))
            if name == "br":
                out.append((0, " ", block, zone, around))
            if name in VOID or rest.endswith("/") and name not in BLOCK:
                continue
            if name in ("article", "main") and around == 1:
                around = 0
            other = max(other, around, name == "header" and not zone)
            if not other:
                zone = max(zone, 2 if name == "article" else 1 if name == "main" else 0)
                highest = max(highest, zone)
            stack.append((name, path, other, zone))
            opened[name] += 1
        if at < len(page):
            text(page[at:])
        return out, highest

    def main_text(self, page: str, template: dict | None = None) -> str:
        """The text of the slots that are the article's."""
        tokens, zone = self.tokens(page)
        blocks: dict = {}
        for token, piece, block, own, other in tokens:
            if piece is not None and not other and own >= zone and (not template or token not in template):
                blocks.setdefault(block, []).append(references.unescape(piece) if "&" in piece else piece)
        lines = (" ".join("".join(b).split()) for b in blocks.values())
        return "\n".join(line for line in lines if line)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _host() -> F.Column:
    """Host of ``url`` in lower case; null where there is none."""
    found = F.regexp_extract(F.lower("url"), r"^(?:[a-z][a-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(found != "", found)


def web_pages(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, host``; other columns go no further."""
    kept = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return modest_batches(kept.withColumn("host", _host()))


class Vectors:
    """Sums of the occurrence vectors of tokens (and, as token 0, of the pages) in a task."""

    def __init__(self):
        self.sums: dict = {}

    def add(self, host: str, page: int, tokens: list[tuple]) -> None:
        count = Counter(t[0] for t in tokens if t[0])
        tags = {t[0] for t in tokens if t[1] is None}
        number = np.fromiter(count.values(), np.uint64, len(count))
        marks = mix64(np.uint64(page) ^ number * np.uint64(0x9E3779B97F4A7C15)).tolist()
        for (token, n), mark in zip(count.items(), marks):
            have = self.sums.get((host, token))
            if have is None:
                self.sums[host, token] = [1, n, mark, token in tags]
            else:
                have[0] += 1
                have[1] += n
                have[2] ^= mark
        have = self.sums.setdefault((host, 0), [0, 0, 0, False])
        have[0] += 1

    def batch(self):
        import pyarrow as pa

        keys, sums = list(self.sums), list(self.sums.values())
        self.sums = {}
        columns = [[k[0] for k in keys], [_signed(k[1]) for k in keys], [s[0] for s in sums], [s[1] for s in sums],
                   [_signed(s[2]) for s in sums], [s[3] for s in sums]]
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["host", "token", "pages", "n", "vector", "tag"])


def token_vectors(pages: DataFrame) -> DataFrame:
    """``host, token, pages, n, vector, tag`` for every token of a host."""
    def run(batches: Iterator):
        import xxhash

        reader, vectors = Reader(), Vectors()
        for batch in batches:
            for page_id, url, page, host in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html", "host"))):
                key = xxhash.xxh64_intdigest(f"{page_id}\n{url}\n{page}".encode("utf-8", "surrogatepass"))
                vectors.add(host, key, reader.tokens(page)[0])
                if len(vectors.sums) >= HELD:
                    yield vectors.batch()
        if vectors.sums:
            yield vectors.batch()

    found = pages.where("host is not null and html is not null").mapInArrow(run, "host string, token long, pages long, n long, vector long, tag boolean")
    return found.groupBy("host", "token").agg(F.sum("pages").alias("pages"), F.sum("n").alias("n"), F.bit_xor("vector").alias("vector"), F.bool_or("tag").alias("tag"))


def classes(vectors: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``host, class, token, tag``: the candidate classes, a class named by its least token."""
    size = vectors.where("token = 0").select("host", F.col("pages").alias("all_pages")).where(F.col("all_pages") >= least_pages)
    often = vectors.where("token <> 0 and pages >= 2").join(size, "host").where(F.col("pages") >= F.ceil(share * F.col("all_pages")))
    named = often.groupBy("host", "pages", "n", "vector").agg(F.min("token").alias("class"), F.count(F.lit(1)).alias("tokens"), F.bool_or("tag").alias("tags"))
    named = named.where("tokens >= 2 and tags").select("host", "pages", "n", "vector", "class")
    return often.join(named, ["host", "pages", "n", "vector"]).select("host", "class", "token", "tag")


def by_host(found: DataFrame) -> DataFrame:
    """``host, template``: a host's tokens with their classes in one row (bounded, see the top)."""
    return found.groupBy("host").agg(F.collect_list(F.struct("token", "class")).alias("template"))


class Known:
    """Templates as dictionaries of unsigned tokens, kept by host."""

    def __init__(self):
        self.hosts: dict = {}

    def of(self, host, template) -> dict:
        if not template.is_valid:
            return {}
        if host not in self.hosts:
            if len(self.hosts) >= 1024:
                self.hosts.clear()
            self.hosts[host] = {t["token"] & _MASK: t["class"] for t in template.as_py()}
        return self.hosts[host]


def structure(tokens: list[tuple], template: dict) -> dict:
    """class -> (hash of the order of its tokens, its parent, the parent's slot), one page; None in place of
    what differs within the page. A parent is the innermost class with an occurrence under way."""
    size = Counter(template.values())
    seen: dict = {}
    for t in tokens:
        c = template.get(t[0])
        if c is not None:
            seen.setdefault(c, []).append(t[0])
    order = {}
    for c, found in seen.items():
        period = size[c]
        repeats = len(found) % period == 0 and all(found[i] == found[i - period] for i in range(period, len(found))) and len(set(found[:period])) == period
        order[c] = hash(tuple(found[:period])) if repeats else None
    place: dict = dict.fromkeys(seen, 0)
    parent: dict = {}
    under: list = []  # classes whose occurrences are under way, the innermost last
    for t in tokens:
        c = template.get(t[0])
        if c is None or order[c] is None or size[c] == 1:
            continue
        if place[c] == 0:
            now = (under[-1], place[under[-1]]) if under else (0, 0)
            if parent.setdefault(c, now) != now:
                parent[c] = None
            under.append(c)
        elif under[-1] != c:  # crosses another class: neither order nor parent holds
            parent[c] = None
            under.remove(c)
            under.append(c)
        place[c] += 1
        if place[c] == size[c]:
            place[c] = 0
            under.remove(c)
    return {c: (order[c], parent.get(c)) for c in seen}


def valid_classes(pages: DataFrame, templates: DataFrame) -> DataFrame:
    """``host, class, parent, slot``: the classes that are ordered and nested alike on all pages."""
    names = ["host", "class", "low", "high", "parent_low", "parent_high", "slot_low", "slot_high", "whole"]

    def run(batches: Iterator):
        import pyarrow as pa

        reader, known, sums = Reader(), Known(), {}

        def batch_of():
            columns = [[k[0] for k in sums], [k[1] for k in sums], *zip(*sums.values())]
            kinds = [pa.string(), *[pa.int64()] * 7, pa.bool_()]
            out = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
            sums.clear()
            return out

        for batch in batches:
            for page, host, template in zip(batch.column("html").to_pylist(), batch.column("host").to_pylist(), batch.column("template")):
                for c, (order, parent) in structure(reader.tokens(page)[0], known.of(host, template)).items():
                    whole = order is not None and parent is not None
                    o, (p, s) = order or 0, parent or (0, 0)
                    have = sums.get((host, c))
                    if have is None:
                        sums[host, c] = (o, o, p, p, s, s, whole)
                    elif have[0] != o or have[1] != o or have[2] != p or have[3] != p or have[4] != s or have[5] != s or not whole:
                        sums[host, c] = (min(have[0], o), max(have[1], o), min(have[2], p), max(have[3], p), min(have[4], s), max(have[5], s), have[6] and whole)
                if len(sums) >= HELD:
                    yield batch_of()
        if sums:
            yield batch_of()

    found = pages.where("html is not null").join(templates, "host").select("html", "host", "template").mapInArrow(
        run, "host string, class long, low long, high long, parent_low long, parent_high long, slot_low long, slot_high long, whole boolean")
    both = found.groupBy("host", "class").agg(
        *[F.min(c).alias(c) for c in ("low", "parent_low", "slot_low")], *[F.max(c).alias(c) for c in ("high", "parent_high", "slot_high")], F.bool_and("whole").alias("whole"))
    return both.where("whole and low = high and parent_low = parent_high and slot_low = slot_high").select(
        "host", "class", F.col("parent_low").alias("parent"), F.col("slot_low").alias("slot"))


def deduce(pages: DataFrame) -> DataFrame:
    """The hosts' templates: ``host, class, token, tag, parent, slot`` for every token of a valid class."""
    found = written(classes(written(token_vectors(pages), "token-vectors")), "classes")
    valid = valid_classes(pages, written(by_host(found), "candidates"))
    return found.join(written(valid, "valid-classes"), ["host", "class"])


def main_texts(pages: DataFrame) -> DataFrame:
    """``page_id, url, text`` for every page."""
    pages = web_pages(pages)
    templates = written(by_host(deduce(pages).where("not tag").select("host", "class", "token")), "templates")

    def run(batches: Iterator):
        import pyarrow as pa

        reader, known = Reader(), Known()
        for batch in batches:
            texts = [reader.main_text(page, known.of(host, template)) if page else ""
                     for page, host, template in zip(batch.column("html").to_pylist(), batch.column("host").to_pylist(), batch.column("template"))]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    rows = pages.join(templates, "host", "left").select("page_id", "url", "html", "host", "template")
    page_id = pages.schema["page_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"page_id {page_id}, url string, text string")


def digest(pages: DataFrame) -> DataFrame:
    """Contract columns of the registered query."""
    return main_texts(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
