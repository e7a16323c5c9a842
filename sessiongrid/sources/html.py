"""Tables inside HTML pages: links, visible text, and JSON in scripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.checks import require
from ..functions.nulls import is_true
from ..functions.text import fold_accents, normalize_ticker, security_id

#: Instrument types by parts of the upper-case title, the first that fits (fixed values).
INSTRUMENTS = [
    ("ETF", ["BORSA YATIRIM FONU"]),
    ("FUND", ["YATIRIM FONU", "EMEKLİLİK FONU", "FON SEPETİ"]),
    ("WARRANT", ["VARANT"]),
    ("CERTIFICATE", ["SERTİFİKA"]),
    ("RIGHTS_COUPON", ["RÜÇHAN", "YENİ PAY ALMA HAKKI"]),
    ("DEBT_INSTRUMENT", ["TAHVİL", "BONO", "BORÇLANMA ARACI"]),
    ("LEASE_CERTIFICATE", ["KİRA SERTİFİK"]),
]
#: The group of markets of shares, and its markets that hold no shares (fixed values).
SHARE_MARKETS = "PAY PİYASASI"
OTHER_MARKETS = ["YAPILANDIRILMIŞ ÜRÜNLER VE FON PAZARI", "EMTİA PAZARI"]


def links(pages: DataFrame) -> DataFrame:
    """page_id, place and href of each link."""
    found = F.posexplode(F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1))
    return pages.select("page_id", found.alias("place", "href"))


def visible_text(html: Column) -> Column:
    bare = F.regexp_replace(F.regexp_replace(html, r"(?s)<(script|style)\b.*?</(script|style)>", " "), r"<[^>]*>", " ")
    return F.trim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))


def mentions(pages: DataFrame, words: list[str]) -> DataFrame:
    """Pages whose folded visible text has all the words."""
    text = F.lower(fold_accents(visible_text(F.col("html"))))
    keep = F.lit(True)
    for w in words:
        keep = keep & text.contains(w)
    return pages.select("page_id", keep.alias("mentions"))


def script_payloads(pages: DataFrame, schema: str, push: str = "self.__next_f.push") -> DataFrame:
    """page_id and the typed JSON records that scripts push: [1, "id:[...]"] with the document in the string.

    Script arguments are parsed as JSON arrays of one string; the record starts behind the first colon. What does not
    parse is left out.
    """
    calls = F.explode(F.regexp_extract_all("html", F.lit(push.replace(".", r"\.") + r"\((\[.*?\])\)</script>"), 1))
    rows = pages.select("page_id", calls.alias("call")).select("page_id", F.get_json_object("call", "$[1]").alias("s"))
    body = F.substring("s", F.instr("s", ":") + 1, F.length("s"))
    return rows.where("s is not null").select("page_id", F.from_json(body, schema).alias("record")).where("record is not null")


#: Levels of nesting that are searched; a document that goes deeper fails.
DEPTH = 12


def _children(value: str) -> Column:
    """The elements of a list, or the values of an object; none of anything else."""
    none = F.array().cast("array<variant>")
    return F.coalesce(F.try_variant_get(value, "$", "array<variant>"), F.map_values(F.try_variant_get(value, "$", "map<string,variant>")), none)


def script_documents(pages: DataFrame, push: str = "self.__next_f.push") -> DataFrame:
    """page_id and doc (variant): the JSON behind the first colon of the string that a script pushes as second element.

    Scripts that push nothing, something that does not parse, or no such string are passed over.
    """
    script = F.explode(F.regexp_extract_all("html", F.lit(r"(?s)<script[^>]*>(.*?)</script>"), 1))
    call = F.regexp_extract(F.trim("script"), r"(?s)" + push.replace(".", r"\.") + r"\((.*)\)\s*$", 1)
    rows = pages.select("page_id", script.alias("script")).select("page_id", F.try_parse_json(call).alias("pushed"))
    second = F.try_variant_get("pushed", "$[1]", "variant")
    texts = rows.where(F.schema_of_variant(second) == "STRING").select("page_id", F.try_variant_get("pushed", "$[1]", "string").alias("s")).where(F.col("s").contains(":"))
    return texts.select("page_id", F.try_parse_json(F.trim(F.substring("s", F.instr("s", ":") + 1, F.length("s")))).alias("doc")).where("doc is not null")


def only_payload(pages: DataFrame, required: list[str], schema: str, among: tuple[str, str] | None = None) -> DataFrame:
    """page_id and record: the one list within a page's scripts whose items are all objects with the required keys.

    Lists are sought at every level. among: a key and the value that some item must have there. A page with no such
    list, or with several, fails the query, and so does one nested deeper than DEPTH. schema: type of the list.
    """
    rows = script_documents(pages).select("page_id", F.col("doc").alias("value"), F.lit(True).alias("open"))
    for _ in range(DEPTH):
        inner = F.when(F.col("open"), F.transform(_children("value"), lambda x: F.struct(x.alias("value"), F.lit(True).alias("open"))))
        own = F.array(F.struct("value", F.lit(False).alias("open")))
        rows = rows.select("page_id", F.explode(F.concat(own, F.coalesce(inner, F.array().cast("array<struct<value:variant,open:boolean>>")))).alias("x")).select("page_id", "x.*")
    rows = require(rows, ~(F.col("open") & (F.size(_children("value")) > 0)), F.concat(F.lit(f"more than {DEPTH} levels in page "), F.col("page_id").cast("string")))
    items = F.try_variant_get("value", "$", "array<map<string,variant>>")
    fits = (F.size(items) > 0) & F.forall(items, lambda m: is_true(F.size(F.array_intersect(F.map_keys(m), F.array(*map(F.lit, required)))) == len(required)))
    if among:
        fits = fits & F.exists(items, lambda m: is_true(F.try_variant_get(F.element_at(m, among[0]), "$", "string") == among[1]))
    found = rows.where(is_true(fits)).select("page_id", F.to_json("value").alias("payload")).groupBy("page_id").agg(F.count("*").alias("n"), F.min("payload").alias("payload"))
    counted = pages.select("page_id").join(found, "page_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    message = F.concat(F.lit("expected one embedded payload, found "), F.col("n").cast("string"), F.lit(" in page "), F.col("page_id").cast("string"))
    return require(counted, F.col("n") == 1, message).select("page_id", F.from_json("payload", schema).alias("record"))


def companies(records: DataFrame) -> DataFrame:
    """Nested groups of companies as distinct rows; a code field holds one or more share classes."""
    rows = records.select(F.explode("record.content").alias("g")).select(F.inline("g.companies"))
    codes = F.explode(F.split(F.trim("stockCode"), r"\s+"))
    return rows.select("mkkMemberOid", F.col("kapMemberTitle").alias("title"), codes.alias("ticker"), "cityName", "kapMemberType").where("ticker <> ''").dropDuplicates()


def company_rows(records: DataFrame) -> DataFrame:
    """Groups (code, content) as one distinct row for each company and page; nulls become empty texts. A company without an
    identifier or a name fails the query."""
    items = records.select("page_id", F.explode("record").alias("g")).select("page_id", F.explode("g.content").alias("i")).where("i is not null")
    text = lambda c: F.trim(F.coalesce(F.col(f"i.{c}"), F.lit("")))
    names = {"mkk_member_oid": "mkkMemberOid", "company_name": "kapMemberTitle", "stock_code": "stockCode", "city_name": "cityName", "kap_member_type": "kapMemberType"}
    rows = items.select("page_id", *[text(c).alias(name) for name, c in names.items()])
    return require(rows, (F.col("mkk_member_oid") != "") & (F.col("company_name") != ""), F.concat(F.lit("incomplete company in page "), F.col("page_id").cast("string"))).distinct()


def market_rows(records: DataFrame) -> DataFrame:
    """Groups of markets with their lists (three levels) as one row for each listed instrument; nulls become empty."""
    groups = records.select(F.explode("record.data").alias("g"))
    markets = groups.select(F.col("g.title").alias("market_group"), F.explode("g.contents").alias("m"))
    listed = markets.select("market_group", "m.financialMarketOid", "m.marketName", "m.marketOid", F.explode("m.marketDetailContentList").alias("i"))
    text = lambda c: F.trim(F.coalesce(F.col(c), F.lit("")))
    ticker = F.coalesce(normalize_ticker(F.col("i.stockCode")), F.lit(""))
    names = {"market_group": "market_group", "financial_market_oid": "financialMarketOid", "market_name": "marketName", "market_oid": "marketOid", "company_name": "i.title", "types": "i.types", "mkk_member_oid": "i.mkkMemberOid", "fund_oid": "i.fundOid"}
    return listed.select(*[text(c).alias(name) for name, c in names.items()], ticker.alias("candidate_ticker"))


def instrument_type(title: Column, fund_oid: Column) -> Column:
    """By the title; where none fits, a fund if it has a fund's identifier, else a share."""
    upper = F.upper(F.coalesce(title, F.lit("")))
    out = F.when(F.trim(F.coalesce(fund_oid, F.lit(""))) != "", "FUND").otherwise("EQUITY")
    for kind, parts in reversed(INSTRUMENTS):
        fits = F.lit(False)
        for part in parts:
            fits = fits | upper.contains(part)
        out = F.when(fits, kind).otherwise(out)
    return out


def active_universe(markets: DataFrame, companies: DataFrame, ended: DataFrame) -> DataFrame:
    """The rows of markets (market_rows) with instrument_type, the first reason to leave them out, and security_id.

    companies: mkk_member_oid and ticker of active ones; ended: mkk_member_oid of former members. One row stays one row.
    """
    flag = lambda df, c, name: df.where(F.col(c) != "").select(F.col(c).alias(f"{name}_key")).distinct().withColumn(name, F.lit(True))
    rows = markets.withColumn("instrument_type", instrument_type(F.col("company_name"), F.col("fund_oid")))
    for df, c, name, own in [(ended, "mkk_member_oid", "has_ended", "mkk_member_oid"), (companies, "mkk_member_oid", "active_oid", "mkk_member_oid"), (companies, "ticker", "active_code", "candidate_ticker")]:
        known = flag(df, c, name)
        rows = rows.join(known, rows[own] == known[f"{name}_key"], "left").drop(f"{name}_key")
    reason = (
        F.when(is_true(F.col("has_ended")), "KAP_MEMBERSHIP_ENDED")
        .when(F.col("market_group") != SHARE_MARKETS, "NOT_PAY_MARKET")
        .when(F.col("market_name").isin(OTHER_MARKETS), "NON_EQUITY_MARKET")
        .when(F.col("instrument_type") != "EQUITY", F.col("instrument_type"))
        .when(F.col("candidate_ticker") == "", "MISSING_TICKER")
        .when(~is_true(F.col("active_oid")) & ~is_true(F.col("active_code")), "NOT_ACTIVE_KAP_BIST_COMPANY")
        .otherwise("")
    )
    rows = rows.withColumn("exclusion_reason", reason).drop("has_ended", "active_oid", "active_code").withColumn("include_in_v1", F.col("exclusion_reason") == "")
    return rows.withColumn("security_id", F.when(F.col("include_in_v1"), security_id(F.col("candidate_ticker"))).otherwise(""))


def universe_summary(universe: DataFrame) -> DataFrame:
    """Counts by market, by instrument type and by reason (NONE for those that stay), as grouping sets."""
    sets = universe.groupingSets([["market_name"], ["instrument_type"], ["exclusion_reason"]], "market_name", "instrument_type", "exclusion_reason")
    out = sets.agg(F.grouping_id().alias("g"), F.count("*").alias("n"))
    dimension = F.when(F.col("g") == 3, "market_name").when(F.col("g") == 5, "instrument_type").otherwise("exclusion_reason")
    value = F.when(F.col("g") == 3, F.col("market_name")).when(F.col("g") == 5, F.col("instrument_type")).otherwise(F.col("exclusion_reason"))
    return out.select(dimension.alias("dimension"), F.when(value == "", "NONE").otherwise(value).alias("value"), "n")
