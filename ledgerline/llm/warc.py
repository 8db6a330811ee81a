"""WARC derivatives: linked metadata and plain-text conversion records.

Every response record gives a ``metadata`` record (application/warc-fields:
title, source status and headers, source digests, outlinks) and a
``conversion`` record (text/plain). Both name the response in WARC-Refers-To,
keep its target and date and carry digests of their own blocks. Pages are read
in Arrow batches by forward scans: every search starts where the last one ended
and stops for good at an opener without a closer, so a page costs time in
proportion to its length, whatever it holds. There is no shuffle. Files are
written by Spark's text writer: a record ends with CRLF CRLF, its separator.
"""

from __future__ import annotations

import html as markup
import html.entities
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

DATE = "2026-01-01T00:00:00Z"
CRLF = "\r\n"
BLOCK_TAGS = ("p|div|br|hr|h[1-6]|li|ul|ol|dl|dt|dd|tr|table|article|section|nav|main|aside|header|footer|title|"
              "blockquote|pre|form|figure|body|html|head")
#: (opener, closer) of what a page's text leaves out.
HIDDEN = tuple((re.compile(a, re.I), re.compile(b, re.I)) for a, b in (
    ("<!--", "-->"), ("<script[ \t\r\n/>]", "</script[ \t\r\n]*>"), ("<style[ \t\r\n/>]", "</style[ \t\r\n]*>")))
BLOCK = re.compile(f"</?({BLOCK_TAGS})[ \t\r\n/>]", re.I)
TITLE, TITLE_END = re.compile("<title[ \t\r\n/>]", re.I), re.compile("</title", re.I)
HREF = re.compile("""href[ \t\r\n]*=[ \t\r\n]*(?:"([^"]*)"|'([^']*)'|([^ \t\r\n"'=<>`]+))""", re.I)
NBSP = re.compile("&nbsp;|&#160;|&#xa0;", re.I)
BLANKS, LINES = re.compile("[ \t\r\f]+"), re.compile(" ?\n[ \n]*")


def decoded(text: str) -> str:
    """Character references decoded once: named (HTML's whole list), decimal and
    hexadecimal. A no-break space becomes a space."""
    return markup.unescape(NBSP.sub(" ", text)) if "&" in text else text


def without(text: str, opener: re.Pattern, closer: re.Pattern) -> str:
    """``text`` with a space for everything from an opener to the next closer. An
    opener without a closer is text, and so are all after it."""
    out, at = [], 0
    while m := opener.search(text, at):
        end = closer.search(text, m.end())
        if end is None:
            break
        out += [text[at:m.start()], " "]
        at = end.end()
    return "".join([*out, text[at:]])


def plain_text(page: str) -> str:
    """Text of an HTML page: comments, scripts and styles go, block tags end
    lines, other tags go, character references are decoded."""
    for opener, closer in HIDDEN:
        page = without(page, opener, closer)
    out, at = [], 0
    while (start := page.find("<", at)) >= 0 and (end := page.find(">", start)) >= 0:
        out.append(page[at:start])
        if BLOCK.match(page, start, end + 1):
            out.append("\n")
        at = end + 1
    text = decoded("".join([*out, page[at:]]))
    return LINES.sub("\n", BLANKS.sub(" ", text)).strip(" \n")


def title_of(page: str) -> str:
    """Text of the first title element, on one line."""
    start = TITLE.search(page)
    inner = -1 if start is None else page.find(">", start.end() - 1)
    end = None if inner < 0 else TITLE_END.search(page, inner + 1)
    return "" if end is None else " ".join(re.split("[ \t\r\n]+", decoded(page[inner + 1:end.start()]))).strip(" ")


def links_of(page: str) -> list[str]:
    """Targets of href attributes, double-quoted, single-quoted or bare."""
    return [re.sub("[\t\r\n]+", "", decoded("".join(g or "" for g in m.groups()))) for m in HREF.finditer(page)]


def read_pages(resp: DataFrame) -> DataFrame:
    """``resp`` with title, links and text of each payload."""
    at = resp.columns.index("payload")
    schema = StructType([*resp.schema.fields]).add("title", "string").add("links", ArrayType(StringType())).add("text", "string")

    def run(batches):
        for b in batches:
            pages = [p or "" for p in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(map(title_of, pages), pa.string()), pa.array(map(links_of, pages), pa.list_(pa.string())),
                 pa.array(map(plain_text, pages), pa.string())], names=[*b.schema.names, "title", "links", "text"])
    return resp.mapInArrow(run, schema)


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def record_id(kind: str | Column, *parts: Column) -> Column:
    """<urn:uuid:...> from the contents, so a rerun names records alike."""
    kind = F.lit(kind) if isinstance(kind, str) else kind
    h = F.md5(F.concat_ws("|", kind, *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def responses(pages: DataFrame, date: str = DATE) -> DataFrame:
    """Response records of fetched pages (page_id, url, html): page_id,
    record_id, target_uri, date, status, headers, payload. Null html is an
    empty payload; a null url stays null."""
    body = F.coalesce(F.col("html"), F.lit(""))
    headers = F.concat(F.lit(f"Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                       F.octet_length(body).cast("string"))
    return pages.select(F.col("page_id").cast("long").alias("page_id"),
                        record_id("response", F.col("page_id"), F.col("url"), F.lit(date), F.sha2(body.cast("binary"), 256))
                        .alias("record_id"), F.col("url").alias("target_uri"), F.lit(date).alias("date"),
                        F.lit(200).alias("status"), headers.alias("headers"), body.alias("payload"))


def derivatives(resp: DataFrame) -> DataFrame:
    """Two records per response: page_id, warc_type, record_id, refers_to,
    target_uri, date, content_type, content_length, block_digest,
    source_digest, block.

    Pages without text still have both records, the conversion with an empty
    block. Equal responses give equal records; an empty table gives none.
    Line breaks in a title become spaces, those in a link go."""
    payload = digest(F.col("payload"))
    links = F.transform("links", lambda x: F.concat(F.lit("outlink: "), x))
    fields = F.concat_ws(CRLF, F.concat(F.lit("title: "), F.col("title")),
                         F.concat(F.lit("source-status: "), F.col("status").cast("string")),
                         F.concat(F.lit("source-"), F.regexp_replace("headers", F.lit("\\r\\n"), F.lit("\r\nsource-"))),
                         F.concat(F.lit("source-payload-digest: "), payload), links)
    kinds = F.array(
        F.struct(F.lit("metadata").alias("warc_type"), F.lit("application/warc-fields").alias("content_type"),
                 fields.alias("block")),
        F.struct(F.lit("conversion").alias("warc_type"), F.lit("text/plain; charset=utf-8").alias("content_type"),
                 F.col("text").alias("block")))
    one = read_pages(resp).select("page_id", F.col("record_id").alias("refers_to"), "target_uri", "date",
                      payload.alias("source_digest"), F.explode(kinds).alias("r"))
    return one.select("page_id", "r.warc_type", record_id(F.col("r.warc_type"), F.col("refers_to")).alias("record_id"),
                      "refers_to", "target_uri", "date", "r.content_type",
                      F.octet_length("r.block").cast("long").alias("content_length"),
                      digest(F.col("r.block")).alias("block_digest"), "source_digest", "r.block")


def serialised(records: DataFrame) -> DataFrame:
    """(value): each record as WARC/1.1 text without the closing CRLF CRLF. A
    null target leaves its header out; line breaks in one are percent-encoded, so
    that no page can add headers."""
    def header(name, col):
        line = F.replace(F.replace(F.col(col).cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
        return F.concat(F.lit(f"{name}: "), line)
    return records.select(F.concat(F.concat_ws(
        CRLF, F.lit("WARC/1.1"), header("WARC-Type", "warc_type"), header("WARC-Record-ID", "record_id"),
        header("WARC-Date", "date"), header("WARC-Target-URI", "target_uri"), header("WARC-Refers-To", "refers_to"),
        header("WARC-Block-Digest", "block_digest"), header("Content-Type", "content_type"),
        header("Content-Length", "content_length")), F.lit(CRLF * 2), F.col("block")).alias("value"))


def write_warc(records: DataFrame, path: str, compression: str = "none") -> None:
    """WARC files under ``path``, in any store that Spark writes to."""
    serialised(records).write.option("lineSep", CRLF * 2).option("compression", compression).text(path)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(file, headers map, block) of uncompressed WARC files, by content length."""
    import pyarrow as pa

    def run(batches):
        for b in batches:
            for name, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at, heads, blocks = 0, [], []
                while at < len(data):
                    stop = data.index(b"\r\n\r\n", at)
                    head = dict(x.split(": ", 1) for x in data[at:stop].decode().split("\r\n")[1:])
                    end = stop + 4 + int(head["Content-Length"])
                    heads.append(list(head.items()))
                    blocks.append(data[stop + 4:end].decode())
                    at = end + 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(heads)), pa.array(heads, pa.map_(pa.string(), pa.string())),
                     pa.array(blocks, pa.string())], names=["file", "headers", "block"])
    return (spark.read.format("binaryFile").load(path).select("path", "content")
            .mapInArrow(run, "file string, headers map<string,string>, block string"))


def op8(pages: DataFrame) -> DataFrame:
    return derivatives(responses(pages))


def oracle_sql() -> str:
    """DuckDB SQL for :func:`op8` over ``pages``, by regular expressions and a map
    of the named references that end in a semicolon (well-formed pages)."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    nl = "chr(13) || chr(10)"
    named = {k[:-1]: v for k, v in markup.entities.html5.items() if k.endswith(";")} | {"nbsp": " "}
    names = ", ".join(map(q, named))
    values = ", ".join(" || ".join(f"chr({ord(c)})" for c in v) for v in named.values())

    def decode(x):
        part = f"""case
            when i = 1 then p
            when regexp_matches(p, '^#160;|^#[xX][aA]0;') then ' ' || substr(p, strpos(p, ';') + 1)
            when regexp_matches(p, '^#[0-9]{{1,7}};') then chr(regexp_extract(p, '^#([0-9]+)', 1)::int) || substr(p, strpos(p, ';') + 1)
            when regexp_matches(p, '^[A-Za-z][A-Za-z0-9]*;') and names[split_part(p, ';', 1)] is not null
              then names[split_part(p, ';', 1)] || substr(p, strpos(p, ';') + 1)
            else '&' || p end"""
        return f"array_to_string(list_transform(string_split({x}, '&'), lambda p, i: {part}), '')"
    steps = (("(?s)<!--.*?-->", " "), ("(?is)<script([ \t\r\n/][^>]*)?>.*?</script[ \t\r\n]*>", " "),
             ("(?is)<style([ \t\r\n/][^>]*)?>.*?</style[ \t\r\n]*>", " "),
             (f"(?i)</?({BLOCK_TAGS})([ \t\r\n/][^>]*)?>", "\n"), ("<[^>]*>", ""))
    text = "payload"
    for pattern, to in steps:
        text = f"regexp_replace({text}, {q(pattern)}, {q(to)}, 'g')"
    text = decode(text)
    for pattern, to in (("[ \t\r\f]+", " "), ("[ \n]*\n[ \n]*", "\n"), ("^[ \n]+|[ \n]+$", "")):
        text = f"regexp_replace({text}, {q(pattern)}, {q(to)}, 'g')"
    title = decode("regexp_extract(payload, '(?is)<title([ \\t\\r\\n][^>]*)?>(.*?)</title', 2)")
    links = """regexp_extract_all(payload, '(?i)href="([^"\\r\\n]*)"', 1)"""

    def uuid(x):
        h = f"md5({x})"
        return ("'<urn:uuid:' || " + " || '-' || ".join(f"substr({h}, {a}, {n})" for a, n in
                ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'")
    rid = uuid(f"concat_ws('|', 'response', coalesce(page_id::varchar, ''), coalesce(url, ''), '{DATE}', sha256(payload))")
    return f"""
with m as (select map([{names}], [{values}]) as names),
p as (select page_id, url, coalesce(html, '') as payload, names from pages, m),
r as (select *, {rid} as refers_to, 'sha256:' || sha256(payload) as source_digest from p),
d as (
  select page_id, url, refers_to, source_digest, 'metadata' as warc_type, 'application/warc-fields' as content_type,
    concat_ws({nl},
      'title: ' || trim(regexp_replace({title}, '[ \\t\\r\\n]+', ' ', 'g')),
      'source-status: 200', 'source-Content-Type: text/html; charset=utf-8',
      'source-Content-Length: ' || strlen(payload)::varchar, 'source-payload-digest: ' || source_digest,
      case when len({links}) > 0 then
        array_to_string(list_transform({links}, lambda x: 'outlink: ' || {decode('x')}), {nl}) end) as block
  from r
  union all
  select page_id, url, refers_to, source_digest, 'conversion', 'text/plain; charset=utf-8', {text} from r)
select page_id, warc_type, {uuid("concat_ws('|', warc_type, refers_to)")} as record_id, refers_to, url as target_uri,
  '{DATE}' as date, content_type, strlen(block)::bigint as content_length, 'sha256:' || sha256(block) as block_digest,
  source_digest, block
from d"""
