"""Till-shaped views of the driver tables, and journal and report texts printed from them.

Orders play the tickets, line items their lines, events the rows of the closing reports. Nothing
here belongs to a run on real till data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tillrecon import fixed
from tillrecon.functions.money import MONEY_TYPE

ID_DIGITS = 12


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(rows: DataFrame) -> DataFrame:
    """Rows over the session's shuffle partitions: a table of one row group would be printed and parsed in one task."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def decimal(column: str | Column) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column.cast(MONEY_TYPE)


def cents(amount: str, alias: str | None = None) -> Column:
    """Amount as a whole number of cents, the form in which results are compared."""
    return (F.col(amount) * 100).cast("bigint").alias(alias or amount)


def net_of(column: str) -> Column:
    """Net part of an amount with 20 % tax, cut to whole cents."""
    return F.expr(f"CAST((CAST({column} * 100 AS BIGINT) * 5 DIV 6) * 0.01BD AS DECIMAL(18,2))")


def digits(column: str) -> Column:
    return F.lpad(F.col(column).cast("string"), ID_DIGITS, "0")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ticket headers; every tenth has a blank number."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    base = orders.select(
        key.alias("block_id"),
        F.concat(F.lit("EJ"), F.date_format(F.to_date("o_orderdate"), "yyyyMM"), F.lit(".TXT")).alias(
            "file_name"
        ),
        (F.col("o_custkey") % 2).cast("string").alias("shop"),
        F.col("o_orderstatus").alias("type"),
        digits("o_orderkey").alias("internal_no"),
        F.when(key % 10 == 0, "  ").otherwise(digits("o_orderkey")).alias("ticket_no"),
        F.to_date("o_orderdate").alias("ticket_date"),
        F.concat(
            F.lpad((key % 24).cast("string"), 2, "0"),
            F.lit(":"),
            F.lpad((key % 60).cast("string"), 2, "0"),
        ).alias("ticket_time"),
        decimal("o_totalprice").alias("ttc"),
        F.substring("o_orderpriority", 1, 1).alias("means"),
    )
    paid = lambda *means: F.when(F.col("means").isin(*means), F.col("ttc"))
    split = base.withColumn("ht1", net_of("ttc"))
    return split.withColumns(
        {
            "vat1": (F.col("ttc") - F.col("ht1")).cast(MONEY_TYPE),
            "pay_card": paid("1", "2"),
            "pay_cheque": paid("3"),
            "pay_cash": paid("4", "5"),
        }
    )


def ticket_lines(spark: SparkSession, sf_dir: str, row_id: bool = False) -> DataFrame:
    """Line items as ticket lines; returned ones carry a correction.

    ``row_id`` adds where the row stands in its file, which tells exact copies apart.
    """
    items = table(spark, sf_dir, "lineitem")
    returned = F.col("l_returnflag") == "R"
    place = F.col("_metadata.file_name"), F.col("_metadata.row_index").cast("string")
    lines = items.select(
        F.col("l_orderkey").alias("block_id"),
        F.col("l_linenumber").alias("line_pos"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        F.when(F.col("l_linestatus") == "F", F.concat(F.lit("PART "), F.col("l_partkey"))).alias("label"),
        F.concat(F.lit("T"), (F.col("l_linenumber") % 4 + 1).cast("string")).alias("vat_code"),
        decimal("l_extendedprice").alias("amount"),
        returned.alias("_returned"),
        F.to_date("l_shipdate").alias("ship_date"),
        *([F.concat_ws("#", *place).alias("row_id")] if row_id else []),
    )
    tenth = F.expr("CAST((CAST(amount * 100 AS BIGINT) DIV 10) * 0.01BD AS DECIMAL(18,2))")
    return lines.withColumn("correction", F.when(F.col("_returned"), -tenth)).drop("_returned")


def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as report rows: the type is the nature, a day is the period, the user picks the mode."""
    events = table(spark, sf_dir, "events")
    mode = (
        F.when(F.col("user_id") % 3 == 0, "Z").when(F.col("user_id") % 3 == 1, "ZZ1").otherwise("ZZ2")
    )
    day = F.to_date("ts")
    return events.select(
        "event_id",
        F.year(day).alias("year"),
        day.cast("string").alias("period"),
        mode.alias("mode"),
        F.col("event_type").alias("designation"),
        F.lit(1).cast("bigint").alias("qty"),
        decimal("value").alias("amount"),
    )


EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


def synthesis_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as rows of the monthly synthesis; one designation is printed in two ways."""
    items = table(spark, sf_dir, "lineitem")
    both = F.concat("l_returnflag", "l_linestatus")
    names = {
        "AF": "CA BRUT",
        "AO": "CA NET",
        "NF": "HORS TAXE 1",
        "NO": "HORS TAXES 1",
        "RF": "TVA 1",
    }
    designation = F.lit("ESP.TIROIR")
    for flags, name in names.items():
        designation = F.when(both == flags, name).otherwise(designation)
    supplier = F.col("l_suppkey") % 3
    date = F.to_date("l_shipdate")
    return items.select(
        F.when(F.col("l_partkey") % 2 == 0, "A").otherwise("B").alias("shop"),
        F.when(supplier == 0, "Z").when(supplier == 1, "ZZ1").otherwise("ZZ2").alias("mode"),
        F.year(date).alias("year"),
        F.date_format(date, "yyyy-MM").alias("period"),
        designation.alias("designation"),
        F.col("l_quantity").cast("bigint").alias("qty"),
        decimal("l_extendedprice").alias("amount"),
    )


def printed(amount: Column, euro: bool = True) -> Column:
    text = F.format_number(amount, 2)
    return F.concat(F.lit("€"), text) if euro else text


def block_text(euro: bool = True) -> Column:
    """A ticket printed as a journal block: line ends, continued lines and padding vary with it.

    Low-priority tickets become type X, which has no sale lines.
    """
    key = F.col("block_id")
    pick = lambda *texts: F.element_at(F.array(*texts), (key % len(texts) + 1).cast("int"))
    amount = lambda c: printed(F.col(c), euro)
    line = lambda c, *parts: F.when(F.col(c).isNotNull(), F.concat(*parts, F.lit("\n")))
    kind = F.when(F.col("means") == "5", "X").when(F.col("type") == "P", "_R_F").otherwise("REG")
    text = F.concat_ws(
        "",
        F.concat(
            F.lit("\n"), kind, F.lit("  "), F.date_format("ticket_date", "dd-MM-yyyy"), F.lit(" "),
            F.col("ticket_time"), F.lit("  \n   "), F.col("internal_no"), F.lit("\n\n"),
        ),
        line("ht1", pick(F.lit("HORS TAXE 1 "), F.lit("HORS TAXE 1\n  "), F.lit("HORS TAXE\n1 ")), amount("ht1")),
        line("vat1", F.lit(" TVA  1   "), amount("vat1")),
        line("ttc", pick(F.lit("TOTAL "), F.lit("TOTAL\n")), amount("ttc"), F.lit(" ")),
        line("pay_card", F.lit("CARTES "), amount("pay_card")),
        line("pay_cash", F.lit("ESPECES   "), amount("pay_cash")),
        line("pay_cheque", F.lit("CHEQUES "), amount("pay_cheque")),
        F.when(F.col("shop") == "1", F.lit("REF./TIROIR .........\n")),
        line("ticket_no", F.lit("FACTURE No. "), F.col("internal_no")),
        F.lit(fixed.SIGNATURE_SEPARATOR + "\n"),
        F.concat(F.lit(" S"), F.col("internal_no"), F.lit("\n\nEND  \n")),
    )
    return F.when(key % 2 == 0, F.replace(text, F.lit("\n"), F.lit("\r\n"))).otherwise(text)


def line_blocks(lines: DataFrame) -> DataFrame:
    """Print every ticket line as a block of its own: an article and, if there is one, a correction."""
    two_lines = F.col("part") % 2 == 0
    article = F.concat(
        F.lit("  "),
        F.col("qty").cast("string"),
        F.lit(" "),
        F.rpad(F.coalesce("label", F.lit("")), 16, " "),
        F.when(two_lines, F.lit("\n")).otherwise(F.lit(" ")),
        F.col("vat_code"),
        F.lit("  "),
        printed(F.col("amount")),
        F.lit("\n"),
    )
    correction = F.concat(
        F.lit("CORRECTION"),
        F.when(two_lines, F.lit("\n")).otherwise(F.lit(" ")),
        F.lit("€-"),
        F.format_number(F.abs("correction"), 2),
        F.lit("\n"),
    )
    text = F.concat_ws("", F.lit("\nREG 02-01-2023 11:25\n7\n"), article, correction)
    return lines.select("block_id", F.col("line_pos").alias("item"), "part", text.alias("block"))


def ticket_blocks(tickets: DataFrame, lines: DataFrame) -> DataFrame:
    """Tickets with all their lines as the tills print them: block_id, block.

    Articles with their corrections, net and tax of four codes, an untaxed amount, and two invoice
    lines of which the last counts. A ticket's lines are few and become one text.
    """
    cent = (F.col("amount") * 100).cast("bigint")
    order = ("line_pos", "part", "qty", cent.alias("cent"), "_corrected", F.col("label").isNotNull().alias("named"))
    article = F.concat(
        F.col("qty").cast("string"), F.lit(" "), F.coalesce("label", F.lit("")), F.lit(" "), "vat_code", F.lit(" "), printed(F.col("amount")), F.lit("\n")
    )
    correction = F.when(
        F.col("correction").isNotNull(), F.concat(F.lit("CORRECTION €-"), F.format_number(F.abs("correction"), 2), F.lit("\n"))
    )
    each = lines.withColumn("_corrected", F.col("correction").isNotNull()).select(
        "block_id", F.struct(*order, F.concat_ws("", article, correction).alias("text")).alias("line")
    )
    body = each.groupBy("block_id").agg(F.array_sort(F.collect_list("line")).alias("printed"))
    codes = F.concat_ws(
        "",
        *(
            F.concat(F.lit(f"HORS TAXE {code} €"), (F.col("block_id") % 97 + int(code)).cast("string"), F.lit(f".00\nTVA {code} €{code}.50\n"))
            for code in fixed.VAT_CODES
        ),
    )
    kind = F.when(F.col("type") == "P", "_R_F").otherwise("REG")
    text = F.concat(
        F.lit("\n"), kind, F.lit("  "), F.date_format("ticket_date", "dd-MM-yyyy"), F.lit(" "), F.col("ticket_time"),
        F.lit("\n"), F.col("internal_no"), F.lit("\n"), F.array_join("printed.text", ""), codes, F.lit("NON TAXABLE €"),
        (F.col("block_id") % 13).cast("string"), F.lit(".00\nTOTAL "), printed(F.col("ttc")),
        F.lit("\nFACTURE No. 1\nFACTURE No. "), F.col("internal_no"), F.lit("\n"),
    )
    return tickets.join(body, "block_id").select("block_id", text.alias("block"))


# Ways to break a block, and the error each of them has to give.
DAMAGES = (
    ("header:format", "\nREG 02/01/2023 11:25\n7\n"),
    ("header:date", "\nREG 31-02-2023 11:25\n7\n"),
    ("header:time", "\nREG 02-01-2023 25:00\n7\n"),
    ("header:internal_no", "\nREG 02-01-2023 11:25\n   \n"),
    ("ht:amount", "\nREG 02-01-2023 11:25\n7\nHORS TAXE\n"),
    ("ht:code", "\nREG 02-01-2023 11:25\n7\nHORS TAXE 5 €1.00\n"),
    ("total:amount", "\nREG 02-01-2023 11:25\n7\nTOTAL\n"),
    ("exempt:amount", "\nREG 02-01-2023 11:25\n7\nNON TAXABLE"),
    ("correction:amount", "\nREG 02-01-2023 11:25\n7\nCORRECTION\n\n"),
    ("article:format", "\nREG 02-01-2023 11:25\n7\n1 ARTICLE\n"),
    ("card:repeated", "\nREG 02-01-2023 11:25\n7\nCARTES €1.00\nCARTES €1.00\n"),
    ("signature:missing", "\nREG 02-01-2023 11:25\n7\n2-----------------------\n"),
)


def damaged_blocks(tickets: DataFrame) -> DataFrame:
    """Every ticket as a block; returns are broken in one of the ways above."""
    broken = F.element_at(
        F.array(*(F.lit(text) for _, text in DAMAGES)),
        (F.col("block_id") % len(DAMAGES) + 1).cast("int"),
    )
    text = F.when(F.col("type") == "P", broken).otherwise(block_text())
    return tickets.select("block_id", text.alias("block"))


REPORT_HEAD = (
    '"MODELE          ","                "',
    '"MACHINE         ","TILL-7  "',
    '"RAPPORT         ","MONTH END   "',
    '"FICHIER         ","FILE042"',
)


def report_texts(rows: DataFrame) -> DataFrame:
    """Print one report per period and mode from report rows.

    Rows are added up per nature first, so what is gathered into a report is one entry per nature,
    never the rows themselves.
    """
    totals = rows.groupBy("period", "mode", "designation").agg(
        F.sum("qty").alias("qty"), F.sum("amount").alias("amount")
    )
    row = F.concat(
        F.lit('"'), F.rpad("designation", 12, " "), F.lit('"," '), F.col("qty").cast("string"),
        F.lit('","'), F.format_number("amount", 2), F.lit('"'),
    )
    reports = totals.groupBy("period", "mode").agg(
        F.array_sort(F.collect_list(F.struct("designation", row.alias("row")))).alias("_rows")
    )
    numbered = F.transform(
        "_rows",
        lambda x, i: F.concat(F.lit('"'), F.lpad((i + 1).cast("string"), 4, "0"), F.lit('",'), x["row"]),
    )
    head = F.concat(
        F.lit("\r\n".join(REPORT_HEAD) + "\r\n"),
        F.lit('"MODE            ","'), F.rpad("mode", 4, " "), F.lit('"\r\n'),
        F.lit('"COMPTEUR Z      ","0021"\r\n"DATE            ","'),
        F.date_format(F.to_date("period"), "dd-MM-yyyy"),
        F.lit('"\r\n"HEURE           ","13:48"\r\n\r\n'),
        F.lit('"ENREGISTREMENT  ","DESIGNATION     ","QUANTITE/No     ","MONTANT         "\r\n'),
    )
    return reports.select(
        F.concat_ws("/", "period", "mode").alias("report_id"),
        F.concat(head, F.array_join(numbered, "\r\n"), F.lit("\r\n")).alias("text"),
    )
