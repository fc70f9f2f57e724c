"""Electronic journals: ticket blocks to tickets and their lines.

A block is parsed inside its row, in whole-text steps that Spark compiles: line ends are made equal,
lines that continue on the next one are joined, and every line of a known form is rewritten as
``kind, code, amount`` with a field mark between. Only then is the text cut into an array, from
which the ticket's fields are picked. Tickets and lines come out of the same row, so nothing is
shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from tillrecon import fixed
from tillrecon.functions.money import bare_money, signed
from tillrecon.functions.periods import clock_time
from tillrecon.functions.text import fail_unless, unix_lines
from tillrecon.operators.tables import computed_once

AMOUNTS = (
    *(f"ht{code}" for code in fixed.VAT_CODES),
    *(f"vat{code}" for code in fixed.VAT_CODES),
    "ht_exempt",
    "ttc",
    "pay_card",
    "pay_cash",
    "pay_cheque",
)
HEADER = (
    "type",
    "event",
    "signature",
    "internal_no",
    "ticket_no",
    "ticket_date",
    "ticket_time",
    *AMOUNTS,
)

# Two marks between a line and the one it continues on, and between the fields of a rewritten line.
# Both end a line in the source, so none of them is left once line ends are made equal.
_JOINT, _MARK = "\x1D", "\x1E"
# White space left inside a line, with and without a joint; and what makes up a word.
_SPACE = r"[ \t\x1F\xA0]"
_BLANK = r"[ \t\x1F\xA0\x1D]"
_WORD = r"[^ \t\x1F\xA0\n\x1D\x1E]"
# The superscripts of latin-1 open an article line as digits do.
_DIGIT = "[0-9²³¹]"
_HEADER = fixed.HEADER_LINE.replace(r"\s", _BLANK)
_ARTICLE = fixed.ARTICLE_LINE.replace(r"\s", _BLANK)
_ARTICLE_KIND = "article"

_START = dict(fixed.LINE_STARTS)


def _any_of(*kinds: str) -> str:
    return "|".join(re.escape(_START[k]).replace(r"\ ", " ") for k in kinds)


_AMOUNT_KINDS = ("total", "exempt", "card", "cash", "cheque", "correction")
# A line that takes in the next one: too few words for its kind, or a digit that opens no article.
_CONTINUED = (
    r"(?md)^("
    rf"{_START['ht']}{_WORD}*(?:{_BLANK}+{_WORD}+)?"
    rf"|(?:{_any_of('total', 'exempt', 'correction')}){_WORD}*"
    rf"|(?!{_ARTICLE.replace('(', '(?:')}$){_DIGIT}[^\n]*"
    r")\n([^\n]*)"
)
# Lines of a known form become "key, amount": the key is the kind with its tax code, or a blank and
# the kind, so that it equals no line left as it is. An amount found on the next line is all of it.
_KNOWN = (
    r"(?md)^(?:"
    rf"({_any_of('ht', 'vat')}){_WORD}*{_BLANK}+({_WORD}+){_BLANK}+({_WORD}+).*"
    rf"|({_any_of('total', 'exempt')}){_WORD}*\x1D(.*)"
    rf"|({_any_of(*_AMOUNT_KINDS, 'invoice')}){_WORD}*{_BLANK}+({_WORD}+).*"
    r")$"
)
_KNOWN_FIELDS = f"$1 $2$4$6{_MARK}$3$5$7"
_ARTICLE_KEY = " article"
# Article lines: key, amount, tax code, quantity, label.
_ARTICLE_FIELDS = _MARK.join((_ARTICLE_KEY, "$4", "$3", "$1", "$2"))
_KEY = {kind: f" {start}" for kind, start in fixed.LINE_STARTS}
_LINE_KEYS = (_ARTICLE_KEY, _KEY["correction"])
# Keys that may occur once, by the column they fill.
_SINGLE_KEYS = {
    **{f"ht{code}": f"{_START['ht']} {code}" for code in fixed.VAT_CODES},
    **{f"vat{code}": f"{_START['vat']} {code}" for code in fixed.VAT_CODES},
    "ht_exempt": _KEY["exempt"],
    "ttc": _KEY["total"],
    "pay_card": _KEY["card"],
    "pay_cash": _KEY["cash"],
    "pay_cheque": _KEY["cheque"],
}
_DANGLING = rf"^(?:{_any_of('ht', 'vat', *_AMOUNT_KINDS, 'invoice')}|{_DIGIT})"


def split_blocks(text: Column) -> Column:
    """Array of blocks of a whole journal; what stands before the first separator is no block."""
    parts = F.split(text, fixed.TICKET_SEPARATOR)
    return F.slice(parts, F.lit(2), F.size(parts))


def journal_blocks(journals: DataFrame, text: str = "text") -> DataFrame:
    """One row per block, with its position in the journal."""
    keep = [c for c in journals.columns if c != text]
    return journals.select(*keep, F.posexplode(split_blocks(F.col(text))).alias("block_pos", "block"))


def _kind_of(key: Column) -> Column:
    """Name of the kind of a line by its key or its first words, for error codes."""
    text = F.ltrim(key)
    found = F.when(text.rlike(f"^{_DIGIT}"), "article").otherwise(text)
    for kind, start in fixed.LINE_STARTS:
        found = F.when(text.startswith(start), kind).otherwise(found)
    return found


def parse_blocks(blocks: DataFrame, block: str = "block") -> DataFrame:
    """Parse every block into its ticket header, ``lines`` (array of struct) and ``errors`` (array).

    The block text starts right behind its separator. Other columns are carried along. A block with
    an empty ``errors`` array is valid.
    """
    names = [c for c in blocks.columns if c != block]

    # Each step below is a projection of its own, so that what the next one reads several times is
    # computed once.
    # No white space at either end of a line.
    edges = F.rtrim(unix_lines(F.col(block)), F.lit(" \t\x1F\xA0"))
    stripped = F.regexp_replace(edges, rf"{_SPACE}*\n{_SPACE}*", "\n")
    # Separator rest, header line, internal number, and all the rest.
    cut = blocks.select(*names, F.split(stripped, "\n", 4).alias("_part"))
    fields = F.split(
        F.regexp_replace(
            F.get("_part", 1), rf"\A{_HEADER}\z", _MARK.join(("$1", "$2", "$3"))
        ),
        _MARK,
    )
    # With a line feed before and none behind.
    rest = F.get("_part", 3)
    rest = F.when(rest.endswith("\n"), F.substring(rest, F.lit(1), F.length(rest) - 1)).otherwise(rest)
    rest = F.concat(F.lit("\n"), F.coalesce(rest, F.lit("")))
    headed = cut.select(
        *names,
        fields.alias("_header"),
        F.coalesce(F.get("_part", 2), F.lit("")).alias("internal_no"),
        rest.alias("_rest"),
        F.instr(rest, "\n" + fixed.SIGNATURE_SEPARATOR).alias("_sign_at"),
    )
    fits = F.size("_header") == 3
    in_header = lambda i: F.when(fits, F.get("_header", i))
    day = in_header(1)
    is_sale = F.coalesce(in_header(0).isin(*fixed.SALE_TYPES), F.lit(False))
    sign_at = F.col("_sign_at")
    body = F.when(sign_at > 0, F.substring("_rest", F.lit(1), sign_at - 1)).otherwise(F.col("_rest"))
    behind = lambda text: F.get(F.split(text, "\n", 2), F.lit(1))
    signature = behind(F.substring("_rest", sign_at + 1, F.length("_rest")))
    joined = F.regexp_replace(body, _CONTINUED, f"$1{_JOINT}$2")
    articles = F.regexp_replace(joined, rf"(?md)^{_ARTICLE}{_BLANK}*$", _ARTICLE_FIELDS)
    rewritten = headed.select(
        *names,
        in_header(0).alias("type"),
        "internal_no",
        F.when(~day.endswith("-0000"), F.try_to_date(day, "dd-MM-yyyy")).alias("ticket_date"),
        clock_time(in_header(2)).alias("ticket_time"),
        (sign_at > 0).alias("_is_signed"),
        F.when(sign_at > 0, signature).alias("_signature"),
        F.when(is_sale, F.regexp_replace(articles, _KNOWN, _KNOWN_FIELDS)).alias("_body"),
    )
    lines = F.filter(F.split("_body", "\n"), lambda l: l != "")
    # A second separator right behind the first one is tolerated.
    doubled = F.col("_signature").startswith(fixed.SIGNATURE_SEPARATOR)
    words = F.transform(lines, lambda l: F.split(l, _MARK))
    read = rewritten.select(
        *names,
        "type",
        "internal_no",
        "ticket_date",
        "ticket_time",
        "_is_signed",
        F.when(doubled, behind(F.col("_signature"))).otherwise(F.col("_signature")).alias("_signature"),
        words.alias("_words"),
    ).withColumn("_keys", F.transform("_words", lambda w: w[0]))

    at = lambda key: F.array_position("_keys", F.lit(key)).cast("int")
    amount_at = lambda key: F.when(at(key) > 0, bare_money(F.get(F.get("_words", at(key) - 1), F.lit(1))))
    keys, last = F.col("_keys"), F.size("_keys")
    invoice_at = last - F.array_position(F.reverse(keys), F.lit(_KEY["invoice"])).cast("int")
    invoice = F.when(invoice_at < last, F.get(F.get("_words", invoice_at), F.lit(1)))
    read_lines = F.transform(
        F.filter("_words", lambda w: w[0].isin(*_LINE_KEYS)),
        lambda w: F.struct(
            (w[0] == _ARTICLE_KEY).alias("is_article"),
            bare_money(F.get(w, F.lit(1))).alias("amount"),
            F.get(w, F.lit(2)).alias("vat_code"),
            F.get(w, F.lit(3)).try_cast("bigint").alias("qty"),
            F.nullif(F.translate(F.get(w, F.lit(4)), _JOINT, " "), F.lit("")).alias("label"),
        ),
    )
    # What is neither of a known form nor free text.
    expected = (*_SINGLE_KEYS.values(), *_LINE_KEYS, _KEY["invoice"])
    odd = F.filter(
        "_words", lambda w: ~w[0].isin(*expected) & ((F.size(w) > 1) | w[0].rlike(_DANGLING))
    )
    picked = read.select(
        *names,
        "type",
        F.size(F.filter(keys, lambda k: k.startswith(_START["event"]))).alias("_events"),
        F.btrim(F.regexp_replace("_signature", "\n{2,}", "\n"), F.lit("\n")).alias("signature"),
        "internal_no",
        invoice.alias("ticket_no"),
        "ticket_date",
        "ticket_time",
        *(amount_at(key).alias(name) for name, key in _SINGLE_KEYS.items()),
        read_lines.alias("_lines"),
        F.filter(keys, lambda k: k.isin(*_SINGLE_KEYS.values())).alias("_single"),
        F.transform(
            odd,
            lambda w: F.concat_ws(
                ":",
                _kind_of(w[0]),
                F.when(F.size(w) > 1, "code")
                .when(_kind_of(w[0]) == "article", "format")
                .when(_kind_of(w[0]) == "invoice", "number")
                .otherwise("amount"),
            ),
        ).alias("_odd"),
        F.col("_signature").isNull().alias("_sign_missing"),
        F.col("_signature").rlike(rf"(?md)^(?:{fixed.TICKET_SEPARATOR}|{fixed.SIGNATURE_SEPARATOR})").alias(
            "_sign_broken"
        ),
        "_is_signed",
    )

    typed = F.col("type").isNotNull()
    unread = lambda name: F.array_contains("_single", _SINGLE_KEYS[name]) & F.col(name).isNull()
    kind_names = {
        **{f"ht{c}": "ht" for c in fixed.VAT_CODES},
        **{f"vat{c}": "vat" for c in fixed.VAT_CODES},
        "ht_exempt": "exempt",
        "ttc": "total",
        "pay_card": "card",
        "pay_cash": "cash",
        "pay_cheque": "cheque",
    }
    broken = F.array_compact(
        F.array(
            F.when(~typed, "header:format"),
            F.when(typed & F.col("ticket_date").isNull(), "header:date"),
            F.when(typed & F.col("ticket_time").isNull(), "header:time"),
            F.when(F.col("internal_no") == "", "header:internal_no"),
            F.when(F.col("_is_signed") & F.col("_sign_missing"), "signature:missing"),
            F.when(F.col("_sign_broken"), "signature:separator"),
            F.when(F.col("_events") > 1, "event:repeated"),
            *(F.when(unread(name), f"{kind}:amount") for name, kind in kind_names.items()),
        )
    )
    repeated = F.transform(
        F.filter(
            F.array_distinct("_single"),
            lambda k: F.size(F.filter("_single", lambda x: x == k)) > 1,
        ),
        lambda k: F.concat(
            _kind_of(k),
            F.when(k.startswith(" "), "").otherwise(F.substring_index(k, " ", -1)),
            F.lit(":repeated"),
        ),
    )
    bad_lines = F.transform(
        F.filter("_lines", lambda x: x["amount"].isNull() | (x["is_article"] & x["qty"].isNull())),
        lambda x: F.when(~x["is_article"], "correction:amount")
        .when(x["amount"].isNull(), "article:amount")
        .otherwise("article:quantity"),
    )
    none = F.array().cast("array<string>")
    errors = F.array_distinct(
        F.concat(
            broken,
            F.coalesce("_odd", none),
            F.coalesce(bad_lines, none),
            F.when(F.size("_single") != F.size(F.array_distinct("_single")), repeated).otherwise(none),
        )
    )
    sign = lambda amount: signed(amount, F.col("type"))
    lines = F.transform(
        "_lines",
        lambda x, i: F.struct(
            (i + 1).cast("int").alias("line_pos"),
            x["qty"].alias("qty"),
            x["label"].alias("label"),
            x["vat_code"].alias("vat_code"),
            F.when(x["is_article"], sign(x["amount"])).alias("amount"),
            F.when(~x["is_article"], sign(x["amount"])).alias("correction"),
            F.lit(None).cast("string").alias("other_info"),
        ),
    )
    columns = {name: F.col(name) for name in HEADER if name != "event"}
    columns |= {name: sign(F.col(name)) for name in AMOUNTS}
    columns["event"] = F.when(F.col("_events") > 0, _START["event"])
    columns["lines"] = F.coalesce(lines, F.array())
    columns["errors"] = errors
    return computed_once(
        picked, names, [columns[name].alias(name) for name in (*HEADER, "lines", "errors")]
    )


def parse_tickets(parsed: DataFrame) -> DataFrame:
    """Ticket headers of parsed blocks."""
    return parsed.drop("lines")


def parse_ticket_lines(parsed: DataFrame, ids=("block_id",), carry=()) -> DataFrame:
    """Article and correction lines of parsed blocks; ``carry`` keeps header columns (no join)."""
    return parsed.select(*ids, *carry, F.inline("lines"))


def reject_blocks(parsed: DataFrame, mode: str = "fail", names=()):
    """Deal with blocks that have errors.

    ``fail``: the returned DataFrame fails the job that reads a block with errors.
    ``quarantine``: returns (valid blocks, rejected blocks).
    """
    valid = F.size("errors") == 0
    if mode == "quarantine":
        return parsed.filter(valid), parsed.filter(~valid)
    if mode != "fail":
        raise ValueError(f"unknown mode: {mode}")
    where = [F.col(n).cast("string") for n in (names or ("internal_no",))]
    message = F.concat_ws(" ", F.lit("invalid ticket block"), *where, F.array_join("errors", ", "))
    return parsed.filter(fail_unless(valid, F.lit(True), message))
