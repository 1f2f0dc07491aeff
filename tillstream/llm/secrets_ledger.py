"""Secret scans over a content-addressed ledger of blobs. DataFrame functions only.

A text is a blob under its SHA-256, however many paths or versions hold it. The ledger lists which
blob has been scanned under which version of which rule; a scan takes only the blobs that lack one
of them, appends its findings and the ledger rows, and joins findings back to every path. What has
been scanned before, under any path, is not read by a pattern again.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.llm.scratch import save

LEDGER = "blob string, rule string, version int"
FINDINGS = "blob string, rule string, version int, start int, end int"


@dataclass(frozen=True)
class Rule:
    """Matches of ``pattern`` whose ``group`` has ``least`` characters or more; shorter ones are dropped."""

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1


BASE_RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]+", 24),
)
_HEADER = r"-----BEGIN ((?:(?!PRIVATE KEY-----)[A-Z]++ )*+)PRIVATE KEY-----"
#: Up to the END line of the same kind, not across another BEGIN or END.
_TO_END = r"(?:[^-]++|-(?!----(?:BEGIN|END) ))*+-----END \1PRIVATE KEY-----"
_BREAK = r"[\x20\t]*+(?:\r?\n|\r|(?:\\r)?\\n)"
#: Without END: header fields, then lines of base64 alone, and long runs of it wherever lines were joined.
_LINES = (
    rf"(?:{_BREAK}[A-Za-z][A-Za-z0-9-]*+:[^\r\n\\]*+)*+"
    rf"(?:(?:{_BREAK}){{1,2}}+[\x20\t]*+[A-Za-z0-9+/=]++(?=[\x20\t]*+(?:[\r\n\\\x22']|\z))"
    rf"|(?:{_BREAK})*+[\x20\t]*+[A-Za-z0-9+/=]{{32,}}+)++"
)
#: Public formats of credentials beside the base rules. Repeats are possessive, so matches of any length need no stack.
MORE_RULES = (
    Rule("private_key", rf"{_HEADER}(?:{_TO_END}|{_LINES})?+", 1, version=2),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 1),
    Rule("url_login", r"[a-z][a-z0-9+]{1,15}://[^\s:@/]++:[^\s:@/]{3,}+@(?=[A-Za-z0-9])", 1, version=2),
)
RULES = BASE_RULES + MORE_RULES
#: A pattern that only texts with a long enough match can pass; it is far cheaper than all matches.
QUICK = {
    "assign": r"(?i:(?:password|passwd|secret|token|api_?key)[\x22']?\x20*[:=])",
    "access": r"AKIA[A-Z0-9]{16}",
    "hex": r"[0-9a-f]{24}",
    "private_key": _HEADER,
}


def spans(text: str, rule: Rule) -> Column:
    """``array<struct<start, end>>`` of the leftmost non-overlapping matches that are long enough.

    The texts between the matches and the matches themselves give the positions as running sums of
    lengths in code points.
    """
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    measured = found if rule.group == 0 else F.regexp_extract_all(text, pattern, F.lit(rule.group))
    matches = F.zip_with(found, measured, lambda m, part: F.struct(F.length(m).alias("match"), F.length(part).alias("part")))
    # One gap more than matches: the last one comes with a null match.
    pieces = F.zip_with(F.split(text, rule.pattern, -1), matches, lambda gap, m: F.struct(
        F.length(gap).alias("gap"), F.coalesce(m["match"], F.lit(0)).alias("match"),
        F.coalesce(m["part"], F.lit(-1)).alias("part")))
    none = F.expr("struct(0 as at, cast(array() as array<struct<start: int, end: int>>) as kept)")

    def step(state, piece):
        start = state["at"] + piece["gap"]
        end = start + piece["match"]
        kept = F.when(
            piece["part"] >= rule.least,
            F.concat(state["kept"], F.array(F.struct(start.alias("start"), end.alias("end"))))
        ).otherwise(state["kept"])
        return F.struct(end.alias("at"), kept.alias("kept"))

    return F.aggregate(pieces, none, step)["kept"]


def unseen(paths: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, path_id, missing)``: blobs that lack rules, one path that holds each, the rules.

    Copies are counted by hash in the map tasks, so a text that a third of all paths hold is one row.
    """
    wanted = F.array(*[F.lit(f"{r.kind}@{r.version}") for r in rules])
    done = ledger.groupBy("blob").agg(F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("done"))
    return (
        paths.groupBy("blob").agg(F.min("path_id").alias("path_id")).join(done, "blob", "left")
        .withColumn("missing", F.array_except(wanted, F.coalesce("done", F.expr("cast(array() as array<string>)"))))
        .where("size(missing) > 0").select("blob", "path_id", "missing")
    )


def findings_of(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``(blob, rule, version, start, end)`` of the rules each blob lacks."""
    none = F.expr("cast(array() as array<struct<rule: string, version: int, start: int, end: int>>)")

    def of(rule: Rule) -> Column:
        asked = F.array_contains("missing", f"{rule.kind}@{rule.version}") & F.rlike(
            "text", F.lit(QUICK.get(rule.kind, rule.pattern)))
        named = F.transform(spans("text", rule), lambda s: F.struct(
            F.lit(rule.kind).alias("rule"), F.lit(rule.version).alias("version"), s["start"].alias("start"),
            s["end"].alias("end")))
        return F.when(asked, named).otherwise(none)

    return blobs.select("blob", F.explode(F.concat(*[of(r) for r in rules])).alias("f")).select("blob", "f.*")


def scan(versions: DataFrame, path_column: str, rules: tuple[Rule, ...] = RULES, ledger: DataFrame | None = None,
         findings: DataFrame | None = None, carry: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scan what the ledger lacks. Gives ``(found, ledger, findings)``.

    ``found`` has every row of ``versions`` (its columns ``carry``, or all) as the struct ``row``, with
    its ``blob`` and ``found``, the
    spans of all rules in their current version as ``array<struct<start, kind_order, kind, end>>``,
    sorted by start and then by the order of ``rules`` (null: none). ``ledger`` and ``findings`` hold
    the old rows and the new ones and belong into the next call. A null text is the empty blob;
    repeated paths and texts give equal spans; a null path is a path like any other.
    """
    spark = versions.sparkSession
    ledger = ledger if ledger is not None else spark.createDataFrame([], LEDGER)
    findings = findings if findings is not None else spark.createDataFrame([], FINDINGS)
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = versions.select(F.struct(*(carry or versions.columns)).alias("row"), F.sha2(text, 256).alias("blob"))
    paths = versions.select(
        F.sha2(text, 256).alias("blob"), text.alias("text"),
        F.coalesce(F.col(path_column).cast("string"), F.lit("")).alias("path_id"))
    lacking = save(unseen(paths.select("path_id", "blob"), ledger, rules), "unseen")
    # Rows of one path and blob are made one in the map tasks, however many there are, and scanned once.
    once = paths.groupBy("path_id", "blob").agg(F.first("text").alias("text"))
    texts = lacking.join(once, ["path_id", "blob"])
    new_findings = save(findings_of(texts.select("blob", "text", "missing"), rules), "findings")
    marked = lacking.select("blob", F.explode("missing").alias("m")).select("blob", F.split("m", "@").alias("m")).select(
        "blob", F.col("m")[0].alias("rule"), F.col("m")[1].cast("int").alias("version"))
    ledger, findings = ledger.unionByName(marked), findings.unionByName(new_findings)
    current = F.col("rule").isNull()
    order = F.lit(len(rules))
    for i, rule in enumerate(rules):
        current = current | ((F.col("rule") == rule.kind) & (F.col("version") == rule.version))
        order = F.when(F.col("rule") == rule.kind, i).otherwise(order)
    by_blob = (
        findings.where(current).select("blob", F.struct(
            "start", order.alias("kind_order"), F.col("rule").alias("kind"), "end").alias("f")).distinct()
        .groupBy("blob").agg(F.array_sort(F.collect_list("f")).alias("found"))
    )
    found = rows.join(by_blob, "blob", "left")
    return found, ledger, findings


def digest(found: str, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the found spans, joined by commas; only of ``kinds`` if given."""
    rows = F.col(found) if kinds is None else F.filter(found, lambda f: f["kind"].isin(*kinds))
    return F.coalesce(F.array_join(F.transform(rows, lambda f: F.concat_ws(
        ":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))), ","), F.lit(""))


def masked(text: str, found: str, mask: str = "[secret]") -> Column:
    """``text`` with every found span replaced; overlapping spans are one. Without spans, unchanged."""
    state = F.expr("struct(0 as at, '' as out)")

    def step(s, f):
        gap = F.when(f["start"] >= s["at"], F.concat(
            F.substring(F.col(text), s["at"] + 1, f["start"] - s["at"]), F.lit(mask))).otherwise(F.lit(""))
        return F.struct(F.greatest(s["at"], f["end"]).alias("at"), F.concat(s["out"], gap).alias("out"))

    end = F.aggregate(found, state, step)
    rest = F.concat(end["out"], F.substring(F.col(text), end["at"] + 1, F.length(text)))
    return F.when(F.size(found) > 0, rest).otherwise(F.col(text))
