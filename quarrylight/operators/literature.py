"""Literature organisation as plans: identity keys, canonical files, target names, collisions, attachment numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarrylight.functions import text as X

# Fixed values.
SUPPLEMENT = ("supplementary_information", "supplementary information", "supporting information", "suppmat", "moesm", "source data", "source_data")
PATENT = r"\b(?:CN\s?\d{7,12}[A-Z]|US\s?\d{7,14}[A-Z]?\d?|WO\s?\d{6,14}[A-Z]?\d?)\b"


def is_supplement(name: Column) -> Column:
    """By a marker in the name, or the word SI between spaces, hyphens, underscores or a dot after it."""
    low = F.lower(name)
    out = F.regexp_like(low, F.lit(r"(?:^|[ _-])si(?:[ _.-]|$)"))
    for m in SUPPLEMENT:
        out = out | F.contains(low, F.lit(m))
    return out


def bibliographic_key(category: Column, doi: Column, title: Column, year: Column) -> Column:
    """DOI where there is one, else category, plain title and year; null without a title."""
    plain = F.regexp_replace(F.lower(title), "[^0-9a-z\\u4e00-\\u9fff]+", "")
    return F.coalesce(F.concat(F.lit("doi:"), F.lower(doi)), F.when(plain != "", F.concat_ws("|", category, plain, F.coalesce(year.cast("string"), F.lit("")))))


def canonical_files(files: DataFrame) -> DataFrame:
    """files: hash, key, path, penalty. Two rounds: the best path of each hash, then of each key; status canonical, exact_duplicate
    or bibliographic_duplicate. Rows without a key stand alone."""
    order = [F.col("penalty"), F.size(F.split("path", "/")), F.length("path"), F.lower("path"), F.col("path")]
    one = files.withColumn("rn", F.row_number().over(Window.partitionBy("hash").orderBy(*order)))
    first = one.filter("rn = 1").withColumn("kn", F.row_number().over(Window.partitionBy(F.coalesce("key", F.concat(F.lit("hash:"), "hash"))).orderBy(*order)))
    first = first.withColumn("status", F.when(F.col("kn") == 1, "canonical").otherwise("bibliographic_duplicate")).drop("kn")
    return first.unionByName(one.filter("rn > 1").withColumn("status", F.lit("exact_duplicate"))).drop("rn")


def target_name(category: Column, venue: Column, year: Column, title: Column, extension: Column) -> Column:
    stem = F.when(category == "patent", F.concat_ws(" - ", venue, year)).otherwise(F.concat_ws(" - ", X.safe_name(venue, 40), year, X.safe_name(title)))
    return F.concat(category, F.lit("/"), stem, extension)


def collisions(plan: DataFrame, target: str = "target") -> DataFrame:
    """Targets, case aside, that several files would take."""
    return plan.groupBy(F.lower(target).alias("target_key")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def number_attachments(new: DataFrame, taken: DataFrame) -> DataFrame:
    """new: family, hash, extension, source; taken: family, number. Numbers fill gaps in the order of source names; files of one
    (hash, extension) share a number. Native: free numbers and files are ranked and meet by rank."""
    files = new.groupBy("family", "hash", "extension").agg(F.min(F.lower("source")).alias("s"))
    files = files.withColumn("rank", F.row_number().over(Window.partitionBy("family").orderBy("s", "hash", "extension")))
    used = taken.groupBy("family").agg(F.collect_set(F.col("number").cast("int")).alias("used"))
    need = files.groupBy("family").agg(F.count(F.lit(1)).cast("int").alias("k")).join(used, "family", "left")
    none = F.array().cast("array<int>")
    free = F.slice(F.array_sort(F.array_except(F.sequence(F.lit(1), F.col("k") + F.size(F.coalesce("used", none))), F.coalesce("used", none))), F.lit(1), F.col("k"))
    slots = need.select("family", F.posexplode(free).alias("p", "number")).withColumn("rank", F.col("p") + 1)
    return files.join(slots, ["family", "rank"]).select("family", "hash", "extension", "number")


def link_supplements(supplements: DataFrame, mains: DataFrame) -> DataFrame:
    """Each supplement's main paper by DOI where exactly one has it, else the DOI's URL."""
    one = mains.filter(F.col("doi").isNotNull()).groupBy(F.lower("doi").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("main")).filter("n = 1")
    return supplements.withColumn("d", F.lower("doi")).join(one, "d", "left").withColumn("related_paper", F.coalesce("main", F.concat(F.lit("https://doi.org/"), F.col("d")))).drop("d", "n", "main")


def next_id(ids: DataFrame, column: str, prefix: str = "R", width: int = 3) -> DataFrame:
    """The identifier behind the largest one of the form prefix and digits."""
    n = F.regexp_extract(column, f"^{prefix}(\\d+)$", 1).try_cast("bigint")
    top = F.coalesce(F.max(n), F.lit(0)) + 1
    return ids.agg(top.alias("n")).select(F.concat(F.lit(prefix), F.lpad(F.col("n").cast("string"), F.greatest(F.lit(width), F.length(F.col("n").cast("string"))), F.lit("0"))).alias("next_id"))


# What may be an attachment.
ATTACHMENTS = (".xlsx", ".xls", ".csv", ".zip", ".docx", ".txt", ".png", ".jpg", ".jpeg", ".tif", ".tiff", ".md")


def scan(files: DataFrame, output: str | None = None, markdown: bool = False) -> DataFrame:
    """Of files (path with slashes; maybe supplementary_o) those that can be organised, once each: PDFs, Markdown if asked for, and
    attachments, known by their names or an override. What lies below output is left out."""
    name = F.element_at(F.split("path", "/"), -1)
    extension = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    marked = is_supplement(name)
    if "supplementary_o" in files.columns:
        marked = marked | F.coalesce("supplementary_o", F.lit(False))
    wanted = extension.isin(".pdf", *((".md",) if markdown else ())) | (extension.isin(*ATTACHMENTS) & marked)
    if output is not None:
        wanted = wanted & ~F.startswith("path", F.lit(output.rstrip("/") + "/"))
    return files.filter(wanted).dropDuplicates(["path"])


OVERRIDES = ("category", "venue", "year", "title", "doi", "supplementary", "related_paper", "attachment_number")


def with_overrides(files: DataFrame, overrides: DataFrame, roots: list[str] = ()) -> DataFrame:
    """files (path, maybe resolved: the path without links) with a column x_o for each column x of OVERRIDES that overrides (name, ...)
    has. The first name that is listed counts: the path, the resolved path, the file's name, the path below each root; each as it is,
    then with slashes for backslashes. All columns of that one row hold, nulls too; a name listed twice counts with its least row."""
    given = [c for c in OVERRIDES if c in overrides.columns]
    whole = F.col("resolved") if "resolved" in files.columns else F.col("path")
    below = [F.when(F.startswith(whole, F.lit(r.rstrip("/") + "/")), F.substr(whole, F.lit(len(r.rstrip("/")) + 2))) for r in roots]
    names = [F.col("path"), whole, F.regexp_extract("path", r"([^/]*)$", 1), *below]
    both = F.flatten(F.array(*(F.array(n, F.replace(n, F.lit("\\"), F.lit("/"))) for n in names)))
    found = overrides.select(F.col("name").alias("__name"), F.struct(*given).alias("__row"))
    asked = files.select("path").distinct() if "resolved" not in files.columns else files.select("path", "resolved").distinct()
    asked = asked.select("path", F.posexplode(both).alias("__i", "__name"))
    best = asked.join(found, "__name").groupBy("path").agg(F.min(F.struct("__i", "__row")).alias("__best"))
    out = files.join(best, "path", "left")
    return out.select(*files.columns, *(F.col(f"__best.__row.{c}").alias(f"{c}_o") for c in given))


def family(venue: Column, year: Column, title: Column) -> Column:
    """What a paper's attachments share."""
    return F.concat_ws("\x1f", F.coalesce(venue, F.lit("")), F.coalesce(year.cast("string"), F.lit("")), F.coalesce(title, F.lit("")))


def attached(ledger: DataFrame) -> DataFrame:
    """family, number, hash, extension, path of the attachments that a ledger (path, title, year, venue, hash) lists."""
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    own = F.startswith("path", F.lit("paper/")) & ~F.array_contains(F.split("path", "/"), "..") & F.startswith(name, F.lit("SI - "))
    stem, extension = F.regexp_replace(name, r"\.[^.]*$", ""), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    number = F.coalesce(F.regexp_extract(stem, r" - (\d+)$", 1).try_cast("int"), F.lit(1))
    return ledger.filter(own).select(family(F.col("venue"), F.col("year"), F.col("title")).alias("family"), number.alias("number"), "hash", extension.alias("extension"), "path")


def resolve_supplements(supplements: DataFrame, mains: DataFrame, ledger: DataFrame) -> DataFrame:
    """supplements: source, hash, extension, doi, venue, year, title, related_paper, attachment_number (null: none is given); mains: doi,
    venue, year, title, target of the papers that are ready; ledger: see attached().

    Where exactly one main paper has a supplement's DOI, venue, year, title and related_paper (its target) are the main's; else its own
    related_paper stays, or is the DOI's URL. Without one of the four a supplement is unresolved, else ready. A file that the ledger
    lists keeps its place (preserved_target); the others of a family that has several files, or any in the ledger, get the least free
    numbers in the order of their sources, equal files the same one. Numbers given must be positive."""
    from .assertions import none_of

    none_of(supplements.filter("attachment_number <= 0").select("source", "attachment_number"), "attachment numbers must be positive")
    one = mains.filter("doi IS NOT NULL AND doi <> ''").groupBy("doi").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("venue", "year", "title", "target")).alias("m")).filter("n = 1").drop("n")
    j = supplements.join(one, "doi", "left")
    led = F.col("m").isNotNull()
    own = F.coalesce(F.nullif("related_paper", F.lit("")), F.concat(F.lit("https://doi.org/"), F.nullif("doi", F.lit(""))))
    j = j.select(*(c for c in supplements.columns if c not in ("venue", "year", "title", "related_paper")), *(F.when(led, F.col(f"m.{c}")).otherwise(F.col(c)).alias(c) for c in ("venue", "year", "title")), F.when(led, F.col("m.target")).otherwise(own).alias("related_paper"))
    full = F.lit(True)
    for c in ("venue", "year", "title", "related_paper"):
        full = full & (F.coalesce(F.col(c).cast("string"), F.lit("")) != "")
    j = j.withColumn("status", F.when(full, "ready").otherwise("unresolved")).withColumn("family", F.when(full, family(F.col("venue"), F.col("year"), F.col("title"))))
    listed = attached(ledger)
    places = listed.groupBy("family", "hash", "extension").agg(F.max("path").alias("preserved_target"))
    j = j.join(places, ["family", "hash", "extension"], "left").withColumn("group", F.when(full, F.concat_ws("\x1f", "family", "related_paper")))
    ready = j.filter("status = 'ready'")
    several = ready.groupBy("group", "family").agg((F.count_distinct("hash", "extension") > 1).alias("several")).join(listed.select("family").distinct().withColumn("known", F.lit(True)), "family", "left")
    several = several.filter(F.col("several") | F.col("known"))
    taken = several.join(listed, "family").select(F.col("group").alias("family"), "number").unionByName(ready.filter("attachment_number IS NOT NULL").select(F.col("group").alias("family"), F.col("attachment_number").cast("int").alias("number")))
    open_ = ready.filter("preserved_target IS NULL AND attachment_number IS NULL").join(several.select("group"), "group", "left_semi")
    got = number_attachments(open_.select(F.col("group").alias("family"), "hash", "extension", "source"), taken.distinct()).select(F.col("family").alias("group"), "hash", "extension", F.col("number").alias("__number"))
    out = j.join(got, ["group", "hash", "extension"], "left")
    number = F.coalesce(F.col("attachment_number").cast("int"), F.when(F.col("preserved_target").isNull(), F.col("__number")))
    return out.withColumn("attachment_number", number).drop("__number", "group", "family")


def plan_summary(plan: DataFrame) -> DataFrame:
    """One row of counts of a plan of organise(): files by status, planned ones by category, groups of duplicates, targets that collide,
    the longest target."""
    is_ = lambda s: F.col("status") == s
    counts = plan.agg(
        F.count(F.lit(1)).alias("scanned"), F.count_if(~is_("unresolved") & ~is_("excluded")).alias("ready_before_dedup"), F.count_if(is_("canonical")).alias("planned_unique"),
        *(F.count_if(is_("canonical") & (F.col("category") == c)).alias(f"planned_{c}") for c in ("paper", "patent", "thesis")),
        F.count_if(is_("unresolved")).alias("unresolved_count"), F.count_if(is_("excluded")).alias("excluded_count"),
        F.count_distinct(F.when(is_("exact_duplicate"), F.col("hash"))).alias("exact_duplicate_groups"), F.count_if(is_("bibliographic_duplicate")).alias("bibliographic_duplicates"),
        F.coalesce(F.max(F.length("target")), F.lit(0)).alias("longest_target_path_chars"),
    )
    return counts.crossJoin(collisions(plan.filter("target IS NOT NULL")).agg(F.count(F.lit(1)).alias("filename_collisions")))


def apply_plan(plan: DataFrame, output: str, apply: bool = False, delete_exact_duplicates: bool = False) -> dict:
    """Copies the canonical files of a plan (path, hash, status, target) below output, a folder that all executors see; without apply
    only counts. Raises where files are unresolved, targets collide, or a target holds other bytes. A copy is made beside its target,
    hashed anew and then put in place, so that a task that runs twice does no harm; targets that are there stay. Exact duplicates are
    deleted only if asked for, and only when every copy is right."""
    import hashlib
    import os
    import shutil
    import uuid

    from .assertions import none_of_any

    def digest(path: str) -> str:
        with open(path, "rb") as s:
            return hashlib.file_digest(s, "sha256").hexdigest()

    def state(frames, copy: bool):
        for f in frames:
            done = []
            for source, target, want in zip(f["path"], f["target"], f["hash"]):
                place = os.path.join(output, target)
                if not os.path.exists(place) and copy:
                    os.makedirs(os.path.dirname(place), exist_ok=True)
                    pending = f"{place}.{uuid.uuid4().hex}.tmp"
                    try:
                        shutil.copy2(source, pending)
                        if digest(pending) == want.lower():
                            os.replace(pending, place)
                    finally:
                        if os.path.exists(pending):
                            os.unlink(pending)
                done.append("absent" if not os.path.exists(place) else "same" if digest(place) == want.lower() else "differs")
            f["state"] = done
            yield f[["path", "target", "state"]]

    def delete(frames):
        for f in frames:
            for source in f["path"]:
                if os.path.exists(source):
                    os.unlink(source)
            yield f

    canonical = plan.filter("status = 'canonical'").select("path", "target", "hash")
    kind = "path string, target string, state string"
    before = canonical.mapInPandas(lambda b: state(b, False), kind)
    none_of_any(
        (plan.filter("status = 'unresolved'").select("path"), "files are unresolved"), (collisions(canonical), "targets collide"), (before.filter("state = 'differs'"), "targets hold other bytes"),
    )
    if not apply:
        return {"mode": "preview", **{r["state"]: r["n"] for r in before.groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}}
    after = {r["state"]: r["n"] for r in canonical.mapInPandas(lambda b: state(b, True), kind).groupBy("state").agg(F.count(F.lit(1)).alias("n")).collect()}
    if set(after) - {"same"}:
        raise RuntimeError(f"copies are not right: {after}")
    deleted = plan.filter("status = 'exact_duplicate'").select("path").mapInPandas(delete, "path string").count() if delete_exact_duplicates else 0
    return {"mode": "apply", "copied_or_there": after.get("same", 0), "deleted": deleted}


# Fixed values.
THESIS = ("博士学位论文", "硕士学位论文", "学位论文", "doctoral dissertation", "master's thesis")
EXCLUDED = ("reports", "datasets", "verified_duplicates")
USELESS_TITLES = ("microsoft word", "untitled", "administrator", "doi:")
YEAR = r"(?<!\d)((?:19|20)\d{2})(?!\d)"
PUBLISHED = r"(?is)(?:授权公告日|申请公布日|公开日|published|publication date).{0,40}?((?:19|20)\d{2})"


def classify(files: DataFrame) -> DataFrame:
    """files: path, hash, text, metadata_title, and overrides category_o, venue_o, year_o, title_o, doi_o, and maybe supplementary_o
    (null: none), as with_overrides() gives them.

    Adds extension, supplementary, category, doi, patent_number, school, venue, year, title, status (ready, unresolved, excluded).
    An override wins, then a name such as "venue - year - title" in a folder of its category, then what the text's first
    thousands of characters say. A supplement counts as a paper.
    """
    empty = lambda c: F.nullif(F.trim(c), F.lit(""))
    path, text = F.col("path"), F.coalesce("text", F.lit(""))
    parts = F.split(F.lower(path), "/")
    name = F.element_at(F.split(path, "/"), -1)
    stem, extension = F.regexp_replace(name, r"\.[^.]*$", ""), F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    form = F.split(stem, " - ", 3)
    folder = F.coalesce(F.try_element_at(parts, F.lit(-2)), F.lit(""))
    formed = F.regexp_like(F.coalesce(F.get(form, 1), F.lit("")), F.lit(r"^(?:19|20)\d{2}$"))
    whole = formed & (F.size(form) == 3)
    named = F.when((folder == "paper") & whole, "paper").when(folder.isin("thesis", "学位论文") & whole, "thesis").when((folder == "patent") & formed, "patent")
    number = F.coalesce(*(empty(F.upper(F.regexp_extract(F.replace(t, F.lit(" "), F.lit("")), "(?i)(" + PATENT + ")", 1))) for t in (stem, F.left(text, F.lit(5000)))))
    low = F.lower(F.concat(path, F.lit("\n"), F.left(text, F.lit(8000))))
    thesis = F.lit(False)
    for m in THESIS:
        thesis = thesis | F.contains(low, F.lit(m))
    paper = (extension == ".pdf") & (F.array_contains(parts, "paper") | X.matches(F.left(text, F.lit(12000)), X.DOI, True) | F.contains(low, F.lit("journal")))
    supplement = F.coalesce("supplementary_o", is_supplement(name)) if "supplementary_o" in files.columns else is_supplement(name)
    guessed = F.when(F.array_contains(parts, "patent") | F.contains(F.left(text, F.lit(3000)), F.lit("发明专利")) | number.isNotNull(), "patent").when(thesis, "thesis").when(paper, "paper").otherwise("unknown")
    granted = F.regexp_extract(number, r"^(?:US|WO)((?:19|20)\d{2})", 1)
    year = F.coalesce(empty(granted), empty(F.regexp_extract(text, PUBLISHED, 1)), empty(F.regexp_extract(F.left(text, F.lit(8000)), YEAR, 1))).cast("int")
    school = F.coalesce(
        F.get(F.filter(F.regexp_extract_all(F.left(text, F.lit(6000)), F.lit("([\\u4e00-\\u9fff]{2,18}(?:大学|学院))"), F.lit(1)), lambda s: ~s.isin("硕士学位论文", "博士学位论文")), 0),
        empty(F.regexp_extract(F.left(text, F.lit(6000)), "((?:University|Institute) of [A-Z][A-Za-z &-]{2,60})", 1)),
    )
    title = X.safe_name(F.coalesce("metadata_title", F.lit("")), 1000)
    useless = F.length(title) < 12
    for m in USELESS_TITLES:
        useless = useless | F.contains(F.lower(title), F.lit(m))
    fallback = X.safe_name(stem, 1000)
    best = F.when(~useless, title).when(F.length(fallback) >= 8, fallback)
    out = files.withColumn("extension", extension).withColumn("supplementary", supplement).withColumn("category", F.when(supplement & ~F.coalesce(F.col("category_o") == "exclude", F.lit(False)), "paper").otherwise(F.coalesce("category_o", named, guessed)))
    has_name = named.isNotNull()
    out = out.withColumn("doi", F.when(F.col("category") == "paper", F.coalesce(X.clean_doi(F.col("doi_o")), X.clean_doi(F.left(text, F.lit(16000))))))
    out = out.withColumn("patent_number", F.when(F.col("category") == "patent", F.coalesce(F.when(named == "patent", form[0]), number)))
    out = out.withColumn("school", F.when(F.col("category") == "thesis", F.coalesce(F.when(named == "thesis", form[0]), school)))
    out = out.withColumn("venue", F.coalesce("venue_o", F.when(named == "paper", form[0])))
    out = out.withColumn("year", F.coalesce("year_o", F.when(has_name, F.get(form, 1).try_cast("int")), year))
    out = out.withColumn("title", F.coalesce("title_o", F.when(has_name, F.get(form, 2)), best))
    known = F.when(F.col("category") == "paper", F.col("venue").isNotNull() & F.col("title").isNotNull()).when(F.col("category") == "thesis", F.col("school").isNotNull() & F.col("title").isNotNull()).when(F.col("category") == "patent", F.col("patent_number").isNotNull())
    excluded = (F.col("category") == "exclude") | (F.arrays_overlap(parts, F.array(*map(F.lit, EXCLUDED))) & F.col("category_o").isNull())
    return out.withColumn("status", F.when(excluded, "excluded").when(F.coalesce(known, F.lit(False)) & F.col("year").isNotNull(), "ready").otherwise("unresolved"))


def organise(classified: DataFrame) -> DataFrame:
    """Plan: canonical files that are ready get a target, all rows keep their status. Nothing is moved."""
    ready = classified.filter("status = 'ready'")
    key = F.when(F.col("supplementary"), F.concat(F.lit("si:"), "hash", "extension")).otherwise(bibliographic_key(F.col("category"), F.col("doi"), F.when(F.col("category") == "patent", F.col("patent_number")).otherwise(F.col("title")), F.when(F.col("category") != "patent", F.col("year"))))
    low = F.lower("path")
    penalty = sum((F.contains(low, F.lit(w)).cast("int") for w in ("inbox", "verified_duplicates", "source_packages")), F.lit(0))
    best = canonical_files(ready.withColumn("key", key).withColumn("penalty", penalty).drop("status"))
    venue = F.coalesce(F.when(F.col("category") == "patent", F.col("patent_number")).when(F.col("category") == "thesis", F.col("school")).otherwise(F.col("venue")), F.lit(""))
    venue = F.when(F.col("supplementary"), F.concat(F.lit("SI - "), venue)).otherwise(venue)
    target = target_name(F.col("category"), venue, F.col("year").cast("string"), F.coalesce("title", F.lit("")), F.col("extension"))
    done = best.withColumn("target", F.when(F.col("status") == "canonical", target)).drop("key", "penalty")
    return done.unionByName(classified.filter("status <> 'ready'"), allowMissingColumns=True)
