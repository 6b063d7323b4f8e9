"""Type and sector of a supplier by ordered rules, and how rules, answers and overrides merge."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import values as V
from ..functions.text import strip

# --- fixed values -------------------------------------------------------------------------------------------------

CORPORATE = r"\b(ltd|limited|plc|llp|inc|incorporated|cic|co|company|holdings|group)\b"
LAW = r"\b(chambers|solicitor|solicitors|barrister|barristers|legal|law|advocates|attorneys)\b"
STREET = (
    r"\b(road|rd|street|st|lane|ln|avenue|ave|close|drive|dr|way|court|ct|grove|place|pl|walk|row|hill|gardens|gdns|crescent|cres|terrace|terr|square|sq|park|mews|parade|"
    r"broadway|embankment|wharf|quay|rise|vale|green|common|gate|yard|estate|villas?|cottages?|buildings?|chase|approach|hill)\b"
)
HOUSE_NUMBER = r"^\d+[A-Za-z]?(\s*[-/]\s*\d+[A-Za-z]?)?\s+\S"
TITLE = r"^(mr|mrs|ms|miss|mx|dr|prof|professor|sir|dame|rev|reverend|fr|father|lord|lady|capt|col|major)\b\.?\s+\S"
ORGANISATION = (
    r"\b(school|academy|college|university|nursery|preschool|childcare|care|nursing|residential|home|surgery|clinic|medical|dental|hospital|pharmacy|nhs|construction|build|builders|"
    r"contractor|roofing|plumbing|electrical|heating|glazing|scaffolding|joinery|property|estate|lettings|housing|facilities|recruitment|staffing|resourcing|consult|consultancy|accountant|"
    r"audit|software|technology|digital|systems|telecom|communications|catering|food|restaurant|cafe|bakery|cleaning|janitorial|security|transport|taxi|coach|logistics|haulage|courier|motor|"
    r"garage|vehicle|fleet|energy|utilities|waste|recycling|refuse|landscape|grounds|gardening|tree|print|printing|signage|stationery|media|marketing|advertising|design|publishing|training|"
    r"coaching|tuition|tutor|charity|foundation|trust|community|association|church|mosque|temple|parish|diocese|insurance|bank|finance|financial|leasing|architect|surveyor|engineering|hotel|"
    r"lodge|accommodation|furniture|equipment|supplies|supply|products|wholesale|interpreting|translation|therapy|therapeutic|counselling|psychology|fostering|adoption|art|arts|music|theatre|"
    r"dance|gallery|museum|sport|fitness|leisure|gym|services|service|solutions|enterprises?|partnership|partners|associates|centre|center|project|network|union|club|society|institute|"
    r"council|authority|agency|board|commission)\b"
)
NOT_PERSON = (
    r"\b(house|farm|park|manor|inn|lodge|cottage|cottages|villa|villas|grange|hall|court|cuisine|chemist|profit|store|kiosk|stores|market|garden|gardens|bridge|hill|green|wood|woods|field|"
    r"fields|works|mill|barn|stable|stables|kitchen|deli|grill|bar|pub|tavern|cafe|bistro|palace|castle|tower|gate|cross|point|view|place|lane|road|street|way|close|drive|terrace|square|"
    r"nights?|pleasure|outdoors|connex|cherub|data)\b"
)
REDACTED = r"(personal data|personal information|sensitive data|sensitive supplier|redacted\s*-\s*personal|^redacted$|xxxx?redacted|name\s+redacted|supplier\s+redacted|data\s+redacted|^redacted\s+sensitive)"
MISSING = ["nan", "none", "null", "n/a", "na", ""]
DEPARTMENT = r"(\bdepartment (for|of)\b|\bministry of\b|\bdept (for|of)\b|mhclg|dluhc|cabinet office|home office|hm treasury|foreign[, ].*commonwealth|department for education|defra|department for transport|department for work)"
AGENCY = (
    r"(\bcouncil\b|\bborough\b|county council|city council|hmrc|hm revenue|inland revenue|revenue & customs|revenue and customs|greater london authority|\bgla\b|transport for london|\btfl\b|"
    r"transport trading|\bdvla\b|\bdvsa\b|\bdwp\b|jobcentre|\bnhs\b|clinical commissioning|\bccg\b|teachers? pension|pension agency|pensions agency|environment agency|valuation office|"
    r"land registry|companies house|ofsted|\bpolice\b|fire authority|fire and rescue|combined authority|crown court|magistrates|courts? (and|&) tribunals|hmcts|student loans|"
    r"driver and vehicle|highways england|national highways|\bhsbc government\b|local government)"
)
#: Sector, words that name it; the first that applies counts.
SECTORS = [
    ("Legal services", r"chambers|solicitor|solicitors|barrister|barristers|legal services|\blaw\b|advocates|attorneys|llp"),
    ("Care home / residential care", r"nursing home|care home|residential care|care centre|care center|rest home|domiciliary"),
    ("Children's residential & fostering", r"childrens home|children's home|fostering|foster care|adoption|looked after"),
    ("Care & support services", r"care|caring|supported living|support services|homecare|home care|carers"),
    ("Nursery / childcare", r"nursery|preschool|pre-school|childcare|child care|day care|early years|childmind|playgroup|kids club|after school"),
    ("Higher education", r"university|higher education"),
    ("School / education", r"school|academy|primary|secondary|sixth form|college|education|grammar"),
    ("GP / medical practice", r"surgery|\bgp\b|medical centre|medical practice|health centre|practice"),
    ("Dental practice", r"dental|dentist|orthodont"),
    ("Pharmacy", r"pharmacy|chemist|pharmaceutical"),
    ("Healthcare provider", r"hospital|nhs trust|healthcare|health care|clinic|clinical"),
    ("Therapy & counselling", r"therapy|therapeutic|counselling|counseling|psychology|psychotherapy|psychological"),
    ("Building trades", r"roofing|plumbing|electrical|electrician|heating|glazing|glass|scaffolding|decorating|plastering|joinery|carpentry|fencing|flooring|tiling|brickwork|guttering"),
    ("Construction & contracting", r"construction|builders|building|contractor|contractors|groundwork|civil engineering|demolition|refurbishment"),
    ("Property & facilities", r"facilities management|facilities|property management|property|estate|estates|lettings|landlord|surveyor|surveying|valuation"),
    ("Housing provider", r"housing association|housing|homes|tenant|registered provider"),
    ("Recruitment & staffing", r"recruitment|staffing|resourcing|employment agency|personnel|\bscm\b|temp|temporary|locum|payroll"),
    ("Accountancy & audit", r"accountant|accountancy|audit|auditor|bookkeep|tax"),
    ("Consultancy", r"consult|consultancy|consulting|advisory|advisor"),
    ("IT & technology", r"software|technology|technologies|digital|systems|\bit\b|cyber|data|computing|computers?"),
    ("Telecoms", r"telecom|telecoms|communications|mobile|broadband|networks?"),
    ("Catering & food", r"catering|food|restaurant|cafe|bakery|kitchen|meals"),
    ("Cleaning services", r"cleaning|janitorial|hygiene|laundry"),
    ("Security services", r"security|guarding|surveillance|cctv"),
    ("Passenger transport", r"taxi|private hire|cab|cabs|coach|coaches|minibus|chauffeur"),
    ("Transport & logistics", r"transport|logistics|haulage|courier|freight|removals|distribution"),
    ("Motor & vehicle services", r"motor|garage|vehicle|vehicles|fleet|\bcar\b|cars|automotive|tyres?"),
    ("Utilities & energy", r"energy|electric|electricity|gas|utilities|utility|water|power|solar"),
    ("Waste & recycling", r"waste|recycling|refuse|skip|skips|disposal"),
    ("Grounds & landscaping", r"landscape|landscaping|grounds|gardening|garden|tree|trees|horticult|arboricult|grass"),
    ("Printing & signage", r"print|printing|signage|signs|stationery"),
    ("Media & marketing", r"media|marketing|advertising|\bpr\b|publishing|publications?|creative|film|video|photography|photographic"),
    ("Design", r"design|designers?|graphic"),
    ("Training & tuition", r"training|coaching|tuition|tutor|tutoring|tutors"),
    ("Interpreting & translation", r"interpreting|interpreter|translation|translator|language|languages"),
    ("Charity / voluntary", r"charity|foundation|charitable|voluntary|mencap|mind|samaritans|trust|community|association|society|outreach|aid"),
    ("Religious organisation", r"church|mosque|temple|synagogue|parish|diocese|gurdwara|ministries"),
    ("Insurance", r"insurance|insurers?|underwrit"),
    ("Financial services", r"bank|finance|financial|credit|leasing|capital|investments?"),
    ("Architecture", r"architect|architects|architecture"),
    ("Engineering", r"engineering|engineers?|mechanical"),
    ("Accommodation / hotel", r"hotel|lodge|guest house|accommodation|\bb&b\b|hostel|inn"),
    ("Arts & culture", r"art|arts|music|musical|theatre|theater|dance|gallery|museum|cultural|orchestra|band|choir"),
    ("Sport & leisure", r"sport|sports|fitness|leisure|\bgym\b|swimming|football|athletics"),
    ("Goods & supplies", r"furniture|equipment|supplies|supply|products|wholesale|merchants?|trade|trading"),
    ("Advice & advocacy", r"mediation|advocacy|advice|citizens|welfare"),
]
OTHER_SECTOR = "Other / unclassified"
#: Sector as the rules name it, subtype of the business taxonomy.
SECTOR_SUBTYPES = {
    "Legal services": "Legal", "Care home / residential care": "Care home / residential", "Children's residential & fostering": "Children's residential & fostering",
    "Care & support services": "Home care & supported living", "Nursery / childcare": "Nursery & early years", "Higher education": "Higher education / university",
    "School / education": "Other Education", "GP / medical practice": "GP / health centre", "Dental practice": "Dental practice", "Pharmacy": "Pharmacy",
    "Healthcare provider": "Other Healthcare", "Therapy & counselling": "Therapy & counselling", "Building trades": "Building trades",
    "Construction & contracting": "General construction & contracting", "Property & facilities": "Facilities management",
    "Housing provider": "Housing association / registered provider", "Recruitment & staffing": "Recruitment & staffing", "Accountancy & audit": "Accountancy & audit",
    "Consultancy": "Consultancy", "IT & technology": "IT infrastructure & services", "Telecoms": "Telecoms", "Catering & food": "Catering services",
    "Cleaning services": "Cleaning & janitorial", "Security services": "Security", "Passenger transport": "Other Passenger Transport", "Transport & logistics": "Haulage & freight",
    "Motor & vehicle services": "Vehicle repair & maintenance", "Utilities & energy": "Energy & power", "Waste & recycling": "Waste, recycling & environmental",
    "Grounds & landscaping": "Grounds & landscaping", "Printing & signage": "Printing & signage", "Media & marketing": "Media, marketing & design", "Design": "Media, marketing & design",
    "Training & tuition": "Tuition & training", "Interpreting & translation": "Interpreting & translation", "Charity / voluntary": "Charity / voluntary",
    "Religious organisation": "Religious organisation", "Insurance": "Insurance", "Financial services": "Banking & finance", "Architecture": "Architecture",
    "Engineering": "Engineering", "Accommodation / hotel": "Temporary & emergency accommodation", "Arts & culture": "Arts & culture", "Sport & leisure": "Sport & leisure",
    "Goods & supplies": "Domestic & general goods", "Advice & advocacy": "Advice & advocacy", "Other / unclassified": "Other / unclassified",
}

# --- end of fixed values ------------------------------------------------------------------------------------------


def sector(name: Column) -> Column:
    return F.coalesce(*[F.when(name.rlike(rf"(?i)\b({words})\b"), F.lit(label)) for label, words in SECTORS], F.lit(OTHER_SECTOR))


def _person(name: Column, given: Column, family: Column) -> Column:
    """Two to four plain words, no organisation's word or acronym, a known given name first or second and a known last name.

    given and family are arrays of lower-case names, or null for none; what is known is up to the caller.
    """
    tokens = F.split(name, r"\s+")
    shape = F.size(tokens).between(2, 4) & F.forall(tokens, lambda t: t.rlike(r"^[A-Za-z][A-Za-z'\-.]*$") & ~((t == F.upper(t)) & (F.length(t) <= 4)))
    org = name.rlike(f"(?i){CORPORATE}") | name.rlike(f"(?i){ORGANISATION}") | name.rlike(f"(?i){LAW}") | name.rlike(f"(?i){NOT_PERSON}")
    low = lambda i: F.lower(F.get(tokens, i))
    known = (F.array_contains(given, low(F.lit(0))) | F.array_contains(given, low(F.lit(1)))) & F.array_contains(family, low(F.size(tokens) - 1))
    return F.coalesce(shape & ~org & known, F.lit(False))


def gazetteer(ranks: DataFrame, countries: list[str] | None = None, most: int = V.NAME_RANK_MAX) -> DataFrame:
    """ranks(name, kind given or family, country, rank) -> (token, kind): lower-case names of rank up to ``most`` in any of the countries."""
    near = F.col("country").isin(V.NAME_COUNTRIES if countries is None else countries) & (F.col("rank") <= most)
    return ranks.filter(near).select(F.lower("name").alias("token"), "kind").distinct()


def known_tokens(df: DataFrame, name: str, names: DataFrame) -> DataFrame:
    """(_name, _given, _family): which tokens of each distinct name a gazetteer knows. Distinct tokens alone meet the gazetteer."""
    each = df.select(F.col(name).alias("_name")).distinct().withColumn("token", F.explode(F.array_distinct(F.split(F.lower(strip(F.col("_name"))), r"\s+"))))
    tokens = each.select("token").distinct()
    found = tokens.join(names, "token")
    told = each.join(found, "token").groupBy("_name").agg(F.collect_set(F.when(F.col("kind") == "given", F.col("token"))).alias("_given"), F.collect_set(F.when(F.col("kind") == "family", F.col("token"))).alias("_family"))
    return told


def classify(df: DataFrame, name: str = "supplier_clean", given: list[str] | None = None, family: list[str] | None = None, names: DataFrame | None = None) -> DataFrame:
    """+ type and business_type by the cascade: missing, redacted, department, agency, address, person, else business.

    names is a gazetteer as a table (token, kind); given and family are short lists in its place. Without any a person is told by title only.
    """
    if names is not None:
        known = known_tokens(df, name, names)
        joined = df.join(known, df[name] == known["_name"], "left").drop("_name")
        return _classified(joined, name, F.coalesce("_given", F.array().cast("array<string>")), F.coalesce("_family", F.array().cast("array<string>"))).drop("_given", "_family")
    text = lambda xs: F.array(*[F.lit(x.lower()) for x in xs]) if xs else F.lit(None).cast("array<string>")
    return _classified(df, name, text(given), text(family))


def _classified(df: DataFrame, name: str, g: Column, f: Column) -> DataFrame:
    n = strip(F.coalesce(F.col(name), F.lit("")))
    low = F.lower(n)
    entity = n.rlike(f"(?i){CORPORATE}") | n.rlike(f"(?i){ORGANISATION}") | n.rlike(f"(?i){LAW}")
    redacted = low.rlike(REDACTED) | F.contains(low, F.lit("redact"))
    address = n.rlike(HOUSE_NUMBER) & n.rlike(f"(?i){STREET}") & ~n.rlike(f"(?i){CORPORATE}")
    sides = F.split(n, r"\s*&\s*|\s+and\s+")
    person = n.rlike(f"(?i){TITLE}") | ((F.size(sides) == 2) & _person(F.get(sides, F.lit(0)), g, f) & _person(F.get(sides, F.lit(1)), g, f)) | _person(n, g, f)
    pair = lambda a, b: F.struct(F.lit(a).alias("type"), (F.lit(b) if isinstance(b, str) else b).alias("business_type"))
    verdict = (
        F.when(low.isin(MISSING), pair("Nan", "")).when(redacted & entity, pair("Business", sector(n))).when(redacted, pair("Redacted", "")).when(low.rlike(DEPARTMENT), pair("Department", n))
        .when(low.rlike(AGENCY), pair("Gov Agency", n)).when(address & n.rlike(f"(?i){LAW}"), pair("Business", "Legal services")).when(address, pair("Personal Address", ""))
        .when(person, pair("Persons Name", "")).otherwise(pair("Business", sector(n)))
    )
    return df.withColumn("_v", verdict).withColumn("type", F.col("_v.type")).withColumn("business_type", F.col("_v.business_type")).drop("_v")


def merge_types(suppliers: DataFrame, answers: DataFrame, taxonomy: DataFrame) -> DataFrame:
    """Subtype of each supplier: an override, else the model's answer, else what its rule-given sector maps to.

    suppliers(supplier_clean, business_type, override_business_type), answers(supplier_clean, line_no, business_subtype,
    status), taxonomy(id, business_type, business_subtype). Later answers win; labels outside the taxonomy fall back.
    """
    last = answers.groupBy("supplier_clean").agg(F.max_by(F.struct("business_subtype", "status"), "line_no").alias("a")).select("supplier_clean", F.col("a.business_subtype").alias("_model"), F.col("a.status").alias("_status"))
    table = F.create_map(*[F.lit(x) for k, v in SECTOR_SUBTYPES.items() for x in (k, v)])
    valid = taxonomy.select(F.col("business_subtype").alias("_sub"), F.col("business_type").alias("parent_type"), F.col("id").alias("subtype_id"))
    known = lambda c: valid.select(F.col("_sub").alias(c))
    out = suppliers.join(last, "supplier_clean", "left").withColumn("_told", F.nullif(strip(F.col("override_business_type")), F.lit("")))
    out = out.join(known("_o"), F.col("_told") == F.col("_o"), "left").join(known("_m"), F.col("_model") == F.col("_m"), "left")
    over, model, base = F.col("_o"), F.col("_m"), F.coalesce(F.try_element_at(table, F.col("business_type")), F.lit(OTHER_SECTOR))
    out = out.withColumn("business_subtype", F.coalesce(over, model, base)).withColumn("source", F.when(over.isNotNull(), "override").when(model.isNotNull(), "model").otherwise("baseline"))
    out = out.withColumn("status", F.when(F.col("source") == "model", F.col("_status")).otherwise(F.upper("source")))
    return out.join(valid, F.col("business_subtype") == F.col("_sub"), "left").select("supplier_clean", "business_subtype", "parent_type", "subtype_id", "status", "source")
