"""What one HTML page says, as plain values. Runs inside the parse tasks.

A page is read into a flat, document-ordered record of elements and text runs.
Pages are taken as they are: nothing is closed implicitly, a stray end tag
closes nothing, an end tag closes everything up to its nearest open match, and
void elements hold no content. The contents of any element are then a
contiguous stretch of the record.

Regular markup, nearly all there is, is cut by one expression. From the first
piece that is not plainly regular the standard library's tokenizer, several
times slower, reads the rest; both give the same record.
"""

import re
from bisect import bisect
from collections import defaultdict
from html import parser
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa

# --- Fixed values: markup vocabulary ------------------------------------------
VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input "
    "isindex keygen link menuitem meta nextid param source spacer track wbr".split()
)
# Text inside these belongs to them alone, not to the elements around them.
OWN_TEXT = frozenset(("rp", "rt", "script", "style", "template"))

PAGE_CLASS = "vulnerability-page"
TITLE_CLASS = "title"
DETAILS_CLASS = "vulnerability-details"
PACKAGES_TAG = "osv-tabs"
PACKAGES_CLASS = "vulnerability-packages"
ECOSYSTEM_CLASS = "vuln-ecosystem"
PACKAGE_CLASS = "vuln-name"
RANGES_HEADING = "Affected ranges"
RANGES_CLASS = "vulnerability-package-subsection"
EVENT_CLASS = "mdc-layout-grid__cell--span-9"
SPECIFIC_CLASS = "specific"
DETAIL_LABELS = frozenset((
    "source", "import source", "json data", "aliases", "published", "modified", "severity",
    "summary", "details", "references",
))
RANGE_LABELS = frozenset(("type", "repo", "events"))
REPLACEMENT = "\N{REPLACEMENT CHARACTER}"
# ------------------------------------------------------------------------------


WS = r"[ \t\n\r\f]"
ATTRIBUTE = (
    r"([a-zA-Z_:][-a-zA-Z0-9_:.]*+)"
    r"""(?:=(?:"([^"]*+)"|'([^']*+)'|([^\s"'=<>`]++)(?=[ \t\n\r\f>]|\Z)))?"""
)


def ungrouped(pattern):
    return re.sub(r"\((?!\?)", "(?:", pattern)


ATTRIBUTE_LIST = rf"(?:{WS}++{ungrouped(ATTRIBUTE)})*+"
NAME = r"[a-zA-Z][-a-zA-Z0-9]*+"
REFERENCE = (
    r"&([a-zA-Z][-.a-zA-Z0-9]*+)(?:;|(?=[^-.a-zA-Z0-9;]))"
    r"|&\#([0-9]++|[xX][0-9a-fA-F]++);"
    r"|(&)(?=[^a-zA-Z\#])"
)
SILENT = (
    r"<!--(?!-?>)[^-]*+(?:-(?!-)[^-]*+)*+-->"
    r"|<![dD][oO][cC][tT][yY][pP][eE] [^<>]*+>"
)
# Text up to a piece of regular markup, and that piece; START is its last group where it is a start tag.
PIECE = re.compile(
    rf"([^<&]*+)(?:</({NAME}){WS}*+>|<({NAME})({ATTRIBUTE_LIST}){WS}*+(/?)>"
    rf"|{REFERENCE}|{SILENT})"
)
START, LEAF = 5, 6
# The same, a start tag taken together with text alone and the end tag after it; LEAF is that text.
PIECE_OR_LEAF = re.compile(
    rf"([^<&]*+)(?:</({NAME}){WS}*+>|<({NAME})({ATTRIBUTE_LIST}){WS}*+(/?)>(?:([^<&]*+)</\3>)?+"
    rf"|{REFERENCE}|{SILENT})"
)
ATTRIBUTES = re.compile(ATTRIBUTE)
# Elements whose content is not markup, and what it may be to count as regular.
UNPARSED = {
    "script": re.compile(rf"(?:(?!</\s*script)[\s\S])*+</script{WS}*+>", re.I),
    "style": re.compile(rf"(?:(?!</\s*style)[\s\S])*+</style{WS}*+>", re.I),
    "title": re.compile(rf"[^<]*+</title{WS}*+>", re.I),
    "textarea": re.compile(rf"[^<]*+</textarea{WS}*+>", re.I),
    **dict.fromkeys(
        ("iframe", "noembed", "noframes", "plaintext", "xmp"), re.compile(r"(?!)")
    ),
}
# Elements that are not plainly opened and closed.
UNLIKE = VOID | OWN_TEXT | UNPARSED.keys()
# Regular markup that holds no link, and the link after it if there is one.
LINK = re.compile(
    rf"(?:[^<&]++|</{NAME}{WS}*+>"
    rf"|<(?!(?i:a|{'|'.join(UNPARSED)})(?![-a-zA-Z0-9])){NAME}{ATTRIBUTE_LIST}{WS}*+/?>"
    rf"|{ungrouped(REFERENCE)}|{SILENT})*+"
    rf"(?:<[aA](?P<link>{ATTRIBUTE_LIST}){WS}*+/?>)?"
)

# The tokenizer's own reading of references in attributes, which newer versions
# of Python keep apart from that in text.
unescape = getattr(parser, "_unescape_attrvalue", parser.unescape)

BARE = {}


def regular_attributes(text):
    """Attributes by lower-cased name, the last of a name; no value is ''."""
    found = {}
    for key, double, single, bare in ATTRIBUTES.findall(text):
        value = double or single or bare
        found[key.lower()] = unescape(value) if "&" in value else value
    return found


# Short ones come again from page to page; what is given is shared and not to be changed. A plain
# dictionary, since it travels with the job.
SHARED, ROOM = {}, 1024


def attributes_of(text):
    if not text:
        return BARE
    found = SHARED.get(text)
    if found is None:
        found = regular_attributes(text)
        if len(text) <= 128:
            if len(SHARED) >= ROOM:
                SHARED.clear()
            SHARED[text] = found
    return found


class PageRecord:
    def __init__(self, html):
        # Per element; the page itself is element 0.
        self.tags, self.attrs, self.parents, self.ends = [""], [{}], [-1], [0]
        self.text_from, self.text_to = [0], [0]
        self.texts = []  # (owner kind, text trimmed); blank ones are left out
        self._open, self._own, self._run = [0], [], []
        self._open_tags, self._closed_voids = defaultdict(int), defaultdict(int)
        rest = self._read_regular(html)
        if rest < len(html):
            Tokenizer(self).read(html[rest:])
        self._end_run()
        while self._open:
            self._pop()

    # -- building the record

    def _read_regular(self, html):
        """Read regular markup; the place where it stops being regular.

        Plain start and end tags, most of all pieces, are put into the record right here.
        """
        match, run, own, texts = PIECE_OR_LEAF.match, self._run, self._own, self.texts
        tags, parents, opened, counts = self.tags, self.parents, self._open, self._open_tags
        attributes, ends, text_from, text_to = self.attrs, self.ends, self.text_from, self.text_to
        at = 0
        while piece := match(html, at):
            text, end, start, attrs, slash, inner, name, number, amp = piece.groups()
            tag = (start or end or "").lower()
            if tag and not slash and tag not in UNLIKE:
                if run:
                    run.append(text)
                    self._end_run()
                elif text and (text := text.strip()):
                    texts.append((own[-1] if own else "", text))
                if start:
                    parents.append(opened[-1])
                    tags.append(tag)
                    attributes.append(attributes_of(attrs))
                    text_from.append(len(texts))
                    if inner is None:
                        opened.append(len(ends))
                        counts[tag] += 1
                        ends.append(0)
                        text_to.append(0)
                    else:
                        if inner and (inner := inner.strip()):
                            texts.append((own[-1] if own else "", inner))
                        ends.append(len(tags))
                        text_to.append(len(texts))
                elif tags[opened[-1]] == tag:
                    element = opened.pop()
                    ends[element] = len(tags)
                    text_to[element] = len(texts)
                    counts[tag] -= 1
                else:
                    self.end_tag(tag)
                at = piece.end()
                continue
            unparsed, upto = None, piece.end() if inner is None else piece.start(LEAF)
            if start and tag in UNPARSED and not slash:
                unparsed = UNPARSED[tag].match(html, upto)
                if unparsed is None:
                    return at
            self.data(text)
            if end:
                self.end_tag(tag)
            elif start:
                pairs = attributes_of(attrs)
                if slash:
                    self.closed_tag(tag, pairs)
                else:
                    self.start_tag(tag, pairs)
            elif name:
                self.named(name)
            elif number:
                self.numbered(number)
            elif amp:
                run.append("&")
            else:
                self._end_run()
            at = upto
            if unparsed and tag in ("script", "style"):
                self.data(html[at:html.rindex("<", at, unparsed.end())])
                self.end_tag(tag)
                at = unparsed.end()
        tail = html[at:]
        if "<" in tail or "&" in tail:
            return at
        self.data(tail)
        return len(html)

    def _end_run(self, kind=None):
        run = self._run
        if run:
            text = (run[0] if len(run) == 1 else "".join(run)).strip()
            run.clear()
            if text:
                if kind is None:
                    kind = self._own[-1] if self._own else ""
                self.texts.append((kind, text))

    def _pop(self):
        element = self._open.pop()
        self.ends[element] = len(self.tags)
        self.text_to[element] = len(self.texts)
        tag = self.tags[element]
        self._open_tags[tag] -= 1
        if tag in OWN_TEXT:
            self._own.pop()

    def _push(self, tag, attrs):
        if self._run:
            self._end_run()
        self.parents.append(self._open[-1])
        self._open.append(len(self.tags))
        self._open_tags[tag] += 1
        self.tags.append(tag)
        self.attrs.append(attrs)
        self.ends.append(0)
        self.text_from.append(len(self.texts))
        self.text_to.append(0)
        if tag in OWN_TEXT:
            self._own.append(tag)

    def start_tag(self, tag, attrs):
        self._push(tag, attrs)
        if tag in VOID:
            self._pop()
            self._closed_voids[tag] += 1

    def closed_tag(self, tag, attrs):
        self._push(tag, attrs)
        self.end_tag(tag)

    def end_tag(self, tag):
        # An explicit end tag of a void element already closed is spent on it.
        if tag in VOID and self._closed_voids[tag] > 0:
            self._closed_voids[tag] -= 1
            return
        if self._run:
            self._end_run()
        if self._open_tags[tag] > 0:
            while self.tags[self._open[-1]] != tag:
                self._pop()
            self._pop()

    def named(self, name):
        self._run.append(html5.get(name + ";") or html5.get(name) or "&" + name)

    def numbered(self, number):
        code = int(number[1:], 16) if number[0] in "xX" else int(number)
        try:
            # Pages written in the Windows code page use its numbers.
            char = bytes([code]).decode("windows-1252") if code < 256 else chr(code)
        except UnicodeDecodeError:
            char = chr(code)
        except (ValueError, OverflowError):
            char = REPLACEMENT
        # Half a surrogate pair is no character and cannot be stored as UTF-8.
        self._run.append(REPLACEMENT if 0xD800 <= code <= 0xDFFF else char)

    def data(self, text):
        if text:
            self._run.append(text)

    def markup(self):
        """A comment or declaration: no text, but it ends a run."""
        self._end_run()

    def character_data(self, text):
        self._end_run()
        self._run.append(text)
        self._end_run(kind="")

    # -- reading it

    def inside(self, element, tag=None, cls=None):
        """Elements within ``element``, in order, of a tag and/or class."""
        found = range(element + 1, self.ends[element])
        if tag is not None:
            found = self._of_tag(found.start, found.stop, tag)
        if cls is not None:
            found = (i for i in found if self.has_class(i, cls))
        return iter(found)

    def _of_tag(self, at, end, tag):
        index = self.tags.index
        try:
            while True:
                yield (at := index(tag, at, end))
                at += 1
        except ValueError:
            return

    def has_class(self, element, cls):
        value = self.attrs[element].get("class", "")
        return cls in value and cls in value.split()

    def first(self, element, tag=None, cls=None):
        return next(self.inside(element, tag, cls), None)

    def runs(self, element):
        kind = self.tags[element] if self.tags[element] in OWN_TEXT else ""
        for i in range(self.text_from[element], self.text_to[element]):
            owner, text = self.texts[i]
            if owner == kind:
                yield text

    def text(self, element):
        """Text with runs set apart and whitespace normalised."""
        if element is None:
            return ""
        at, end = self.text_from[element], self.text_to[element]
        if end - at == 1 and self.tags[element] not in OWN_TEXT:
            owner, text = self.texts[at]
            return "" if owner else " ".join(text.split())
        return " ".join(" ".join(self.runs(element)).split())

    def solid_text(self, element):
        """Text with each run trimmed and nothing put between runs."""
        return "".join(self.runs(element))

    def values(self, block):
        """(label, value) elements of a block: a dt and the next dd beside it, or None."""
        parents, after, found = self.parents, {}, []
        dds = list(self.inside(block, "dd"))
        for i in reversed(list(self.inside(block, "dt"))):
            while dds and dds[-1] > i:
                dd = dds.pop()
                after[parents[dd]] = dd
            found.append((i, after.get(parents[i])))
        return found[::-1]

    def enclosing(self, element, cls):
        i = self.parents[element]
        while i > 0:
            if self.has_class(i, cls):
                return i
            i = self.parents[i]
        return None

    def targets(self, links):
        return [self.attrs[a].get("href") for a in links]

    def links(self, element):
        return self.targets(self.inside(element, "a"))


class Tokenizer(HTMLParser):
    """The standard library's reading of any markup, put into a record."""

    def __init__(self, record):
        super().__init__(convert_charrefs=False)
        self.record = record
        self.handle_endtag = record.end_tag
        self.handle_data = record.data
        self.handle_entityref = record.named
        self.handle_charref = record.numbered
        self.handle_comment = self.handle_decl = self.handle_pi = lambda _: record.markup()

    def read(self, html):
        self.feed(html)
        self.close()

    def updatepos(self, _, end):
        return end  # line numbers are of no use here

    def handle_starttag(self, tag, attrs):
        self.record.start_tag(tag, {k: v or "" for k, v in attrs})

    def handle_startendtag(self, tag, attrs):
        self.record.closed_tag(tag, {k: v or "" for k, v in attrs})

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self.record.character_data(data[6:])
        else:
            self.record.markup()


LONGEST_LABEL = max(map(len, DETAIL_LABELS | RANGE_LABELS))


def _label(page, dt, labels):
    """The label in lower case; None, found out early, when it is none of ``labels``."""
    at, end = page.text_from[dt], page.text_to[dt]
    if end - at == 1 and len(page.texts[at][1]) <= LONGEST_LABEL:
        label = page.text(dt).lower()
        return label if label in labels else None
    words, room = [], LONGEST_LABEL
    for run in page.runs(dt):
        for word in run.split():
            words.append(word)
            room -= len(word)
            if room < 0:
                return None
    label = " ".join(words).lower()
    return label if label in labels else None


def _labelled(page, block, labels, extra, read):
    """The labels of a block, with what ``read`` finds in their values.

    Lookups take the first entry of a label, the first with a value or the first
    with a link, so the first of each kind is kept and a page of any size gives
    a bounded list.
    """
    entries, kinds, links = [], set(), list(page.inside(block, "a"))
    for dt, dd in page.values(block):
        label = _label(page, dt, labels)
        if label is None:
            continue
        found = dd is not None
        own = links[bisect(links, dd):bisect(links, page.ends[dd] - 1)] if found else []
        kind = label, found, bool(own)
        if kind not in kinds:
            kinds.add(kind)
            entries.append({
                "label": label,
                "has_dd": found,
                "value": page.text(dd) if found else None,
                extra: read(dd, own) if found else [],
            })
    return entries


def _range_block(page, section):
    for h3 in page.inside(section, "h3"):
        if RANGES_HEADING in page.text(h3):
            part = page.enclosing(h3, RANGES_CLASS)
            return None if part is None else page.first(part, "dl")
    return None


def read_advisory(html):
    """The parsed-page struct of one advisory page; None for a page not read."""
    if html is None:
        return {"has_page": False, "has_details": False}
    try:
        page = PageRecord(html)
    except Exception as e:  # a page the tokenizer refuses is a rejected page
        return {"error": f"{type(e).__name__}: {e}"}
    section = page.first(0, PACKAGES_TAG, PACKAGES_CLASS)
    has_page = page.first(0, cls=PAGE_CLASS) is not None
    dl = page.first(0, "dl", DETAILS_CLASS)
    out = {
        "has_page": has_page,
        "title": page.text(page.first(0, "h1", TITLE_CLASS)),
        "has_details": dl is not None,
        "has_packages": section is not None,
    }
    if not has_page or dl is None:
        return out
    out["details"] = _labelled(page, dl, DETAIL_LABELS, "anchors", lambda _, links: page.targets(links))
    out["specific"] = [page.solid_text(b) for b in page.inside(0, "pre", SPECIFIC_CLASS)]
    if section is not None:
        out["ecosystem"] = page.text(page.first(section, cls=ECOSYSTEM_CLASS))
        out["package"] = page.text(page.first(section, cls=PACKAGE_CLASS))
        block = _range_block(page, section)
        if block is not None:
            out["range"] = _labelled(
                page, block, RANGE_LABELS, "cells",
                lambda dd, _: [page.text(c) for c in page.inside(dd, cls=EVENT_CLASS)],
            )
    return out


def read_title(html):
    """The first heading of a page."""
    if html is None:
        return {"title": ""}
    try:
        page = PageRecord(html)
    except Exception as e:
        return {"error": f"{type(e).__name__}: {e}"}
    return {"title": page.text(page.first(0, "h1"))}


class LinkRecord:
    """The targets of the links of a page, in document order."""

    def __init__(self, html):
        self.hrefs = []
        rest = self._read_regular(html)
        if rest < len(html):
            Tokenizer(self).read(html[rest:])

    def _read_regular(self, html):
        at = 0
        while at < len(html):
            piece = LINK.match(html, at)
            if (attrs := piece["link"]) is not None:
                self.start_tag("a", regular_attributes(attrs))
                at = piece.end()
                continue
            at = piece.end()
            start = PIECE.match(html, at) if at < len(html) else None
            if start is None or start.lastindex != START:
                return at
            tag = start[3].lower()
            content = UNPARSED[tag].match(html, start.end()) if not start[5] else start
            if content is None:
                return at
            at = content.end() if tag in ("script", "style") else start.end()
        return at

    def start_tag(self, tag, attrs):
        if tag == "a":
            self.hrefs.append(attrs.get("href", ""))

    closed_tag = start_tag

    def ignore(self, *_):
        pass

    end_tag = data = named = numbered = markup = character_data = ignore


def read_links(html):
    """Link targets of a page in document order, '' for a link without one."""
    if html is None:
        return {"anchors": []}
    try:
        return {"anchors": LinkRecord(html).hrefs}
    except Exception as e:
        return {"error": f"{type(e).__name__}: {e}"}


# Pages turned into output rows at a time, to bound a task's memory.
CHUNK = 256


def page_job(reader, page_type, html_at):
    """A batch function that puts ``reader(html)`` in place of the HTML column."""

    def run(batches):
        for batch in batches:
            names = batch.schema.names
            kept = [i for i in range(len(names)) if i != html_at]
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                read = [reader(html) for html in part.column(html_at).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in kept] + [pa.array(read, type=page_type)],
                    names=[names[i] for i in kept] + ["page"],
                )

    return run
