"""Word lists and patterns that results depend on."""

# --- fixed values -------------------------------------------------------------------------------------------------

LEGAL_SUFFIXES = ["ltd", "limited", "plc", "llp", "llc", "lp", "cic", "cio", "co", "company", "group", "holdings", "inc", "incorporated", "ug", "gmbh"]
CONNECTORS = ["and", "of"]
ARTICLES = ["the", "a", "an"]
ADORNMENTS = [
    "holdings", "holding", "group", "international", "global", "investments", "investment", "ventures", "trust", "trustee", "trustees", "trustees'",
    "nominee", "nominees", "pension", "pensions", "secretarial", "parent",
]
TLDS = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com", "net", "org", "io", "uk"]
TRAILING_TLDS = ["co.uk", "org.uk", "com", "co", "org", "net", "io", "biz", "info"]
PAYMENT_PREFIX = r"stk\*|wp[-*]|sp[\s*]+|sq\s*\*\s*|iz\s*\*\s*|ztl\*|paypal\s*\*\s*|pp\*|sumup\s*\*?\s*|gocardless\s*\*?\s*"
GATEWAY = r"\s*,\s*SACA\s*|\s*,\s*PLC\s*|(?<!\d)\d{4,}(?!\d)|\b(PAYPAL|SUMUP|ZETTLE|PPOINT|SQ|PIX)[\s_]?\*?"

MONTHS = {"jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12}
MONTHS |= {"january": 1, "february": 2, "march": 3, "april": 4, "june": 6, "july": 7, "august": 8, "september": 9, "october": 10, "november": 11, "december": 12}

STATUTORY_PAYEE = r"hmrc|revenue & customs|inland revenue|greater london authority|gla levies|ministry of housing|department for levelling up|london councils|teachers pensions"
STATUTORY_TERM = r"precept|collection fund|nndr|ndr income|paye|ni creditor|business rates payable|council tax|share of|preceptor|payment to gov dept|payment to other local|pension|voluntary deduction"
LEDGER_TERM = r"ctrl or b/s|control account|balance sheet|holding account|suspense|dd account|creditor control"
INCOME_TERM = r"income|receipt|fees and charges|fairer charging|client contribution|buy.?back|recharge|reimbursement|grant received|rents? received"
ACCOMMODATION_TERM = r"nightly let|temporary accommodation|emergency accommodation|bed and breakfast|nightly paid|private sector lease"
ACQUISITION_TERM = r"acquisition|property purchase|dwellings - acq|land purchase"
CONCESSION_TERM = r"concessionary|freedom pass"
REDACTED_SUPPLIER = r"Redacted|Personal Information|\*"
CATCHALL_LEVELS = ["Consultancy", "Financial Services"]
CONSENSUS_SHARE = 0.6
SCOPES = {"in": "IN_SCOPE", "statutory": "STATUTORY_TRANSFER", "ledger": "LEDGER_CONTROL"}
FLOWS = {"spend": "SPEND", "refund": "REFUND", "income": "INCOME", "reversal": "ACCOUNTING_REVERSAL"}
SENTINELS = {999001: ("Non-Procurement", "Statutory Transfer"), 999002: ("Non-Procurement", "Ledger / Control Account"), 999003: ("Non-Procurement", "Income / Receipts")}
ANCHOR_TARGET = 250000

FACT_COLUMNS = [
    "borough", "payment_type", "date", "year", "amount", "vat", "supplier", "department", "expense_type", "service_area", "supplier_category", "txn_id",
    "source_file", "blank_taxonomy", "batch_start_date",
]
KEY_COLUMNS = ["department", "expense_type", "service_area", "supplier_category", "supplier_clean"]
CARD_WORDS = ["card", "pcard", "p-card", "purchase-card", "procurement-card", "credit-card"]
SHORT_NAME_BOROUGHS = ["havering", "islington", "westminster"]

GENERIC_WORDS = [
    "estate", "estates", "of", "companies", "company", "services", "service", "trading", "international", "uk", "gb", "the", "holdings", "group", "groups",
    "solutions", "partnership", "partnerships", "for", "to", "and",
]
RESIDUE_WORDS = ["public", "community", "interest", "charitable", "organisation", "liability", "partnership"]
PROBE_EXCLUDED_TYPES = ["School / education", "Nursery / childcare", "Religious organisation"]

HEADER_MARKERS = ["date", "month", "year", "amount", "payment"]

# --- end of fixed values ------------------------------------------------------------------------------------------


# --- fixed values -------------------------------------------------------------------------------------------------
#: Names (upper case) that stand for one supplier as a whole.
EXACT_NAMES = {
    "AMZNMKTPLACE": "Amazon Marketplace",
    "AMZN MKTP": "Amazon Marketplace",
    "AMZNBUSINESS": "Amazon Business",
    "AMZN Business": "Amazon Business",
    "AMZ": "Amazon.co.uk",
    "MSFT": "Microsoft",
    "WH SMITH": "WH Smith",
    "WHSMITH": "WH Smith",
    "JOHNLEWIS": "John Lewis",
    "JOHN LEWIS": "John Lewis",
    "WAITROSE": "Waitrose",
    "WAGAMAMA": "Wagamama",
    "WAGAMAMAS": "Wagamama",
    "WASABI": "Wasabi",
    "TRAVELODGE": "Travelodge",
    "UK2": "UK2",
    "UDEMY": "Udemy",
    "VEOLIA": "Veolia",
    "ALDI": "Aldi Supermarket Ltd",
    "ASDA": "Asda Supermarket Ltd",
}
#: Patterns (any case) and the supplier that a matching name stands for; the first that matches counts.
NAME_PATTERNS = [
    (r"^AMZNMKTPLACE", "Amazon Marketplace"),
    (r"^AMZNBUSINESS", "Amazon Business"),
    (r"^AMZ ", "Amazon.co.uk"),
    (r"^AMZN DIGITA", "Amazon Appstore"),
    (r"^Amzn Mktp", "Amazon Marketplace"),
    (r"^AMZNB2BPRIME", "Amazon Business Prime"),
    (r"^AMZNBUSINES", "Amazon Business"),
    (r"^AMZNMKTPLAC", "Amazon Marketplace"),
    (r"^AMZNBUSINESS", "Amazon Business"),
    (r"^WWW AMAZON", "Amazon.co.uk"),
    (r"^Amazon Web Services", "Amazon Web Services"),
    (r"^Amazon EU SARL", "Amazon EU SARL"),
    (r"^Amazon Payments UK Limited", "Amazon Payments UK Limited"),
    (r"^AMZN DIGITAl", "Amazon Appstore"),
    (r"^Amazon\*", "Amazon.co.uk"),
    (r"^Amazon Uk\*", "Amazon.co.uk"),
    (r"^Amazon\.co.uk", "Amazon.co.uk"),
    (r"^Amazon\.com", "Amazon.com"),
    (r"^Amazon Prim", "Amazon Prime"),
    (r"^Amazon Music ", "Amazon Music"),
    (r"^Amazon", "Amazon.co.uk"),
    (r"^EASYJET\b", "Easyjet"),
    (r"^EBAY\b", "Ebay"),
    (r"^MSFT\b", "Microsoft"),
    (r"^WH\s*SMITH", "WH Smith"),
    (r"^WASABI", "Wasabi"),
    (r"^WAGAMAMA", "Wagamama"),
    (r"JOHNLEWIS", "John Lewis"),
    (r"WAITROSE", "Waitrose"),
    (r"^TRAVELODGE", "Travelodge"),
    (r"^UDEMY", "Udemy"),
    (r"^Airbnb", "Airbnb"),
    (r"^Aldi", "Aldi Supermarket Ltd"),
    (r"^Anglian Water", "Anglian Water"),
    (r"^Apple Store", "Apple Store"),
    (r"^B&M", "B&M"),
    (r"^Banyan Uk", "Banyan Uk"),
    (r"^Barchester Healthcare", "Barchester Health care Ltd"),
    (r"^Big Yellow Self Storage", "Big Yellow Self Storage Company Ltd"),
    (r"^Boots ", "Boots The Chemist"),
    (r"^BP ", "BP"),
    (r"^Bright Horizons ", "Bright Horizons"),
    (r"^British Gas", "British Gas"),
    (r"^Busy Bees ", "Busy Bees Nurseries Ltd"),
    (r"^Buzzsprout", "Buzzsprout"),
    (r"^Caffe Nero", "Caffe Nero"),
    (r"^Card Factory", "Card Factory"),
    (r"^Childminder", "Childminder"),
    (r"^Costa Coffee", "Costa Coffee"),
    (r"^Costco", "Costco"),
    (r"^Costcutter", "Costcutter"),
    (r"^Country Court Care Homes", "Country Court Care Homes Ltd"),
    (r"^Currys ", "Currys"),
    (r"^Dropbox", "Dropbox"),
    (r"^Edf Energy", "Edf Energy Ltd"),
    (r"^Etsy", "Etsy.com"),
    (r"^Facebk", "Facebook Ads"),
    (r"^Five Guys", "Five Guys"),
    (r"^Flyingtiger", "Flyingtiger"),
    (r"^Freenow", "Freenow"),
    (r"^Gails ", "Gails Bakery"),
    (r"^Google Cloud", "Google Cloud"),
    (r"^Google Gsuite", "Google Gsuite"),
    (r"^Google Workspace", "Google Workspace"),
    (r"^Grammarly Co", "Grammarly Co"),
    (r"^Greggs", "Greggs"),
    (r"^Heroku", "Heroku"),
    (r"^Holiday Inn", "Holiday Inn"),
    (r"^Home Bargains", "Home Bargains"),
    (r"^Honest Burger", "Honest Burger"),
    (r"^Itsu", "Itsu"),
    (r"^Anglian Water", "Anglian Water"),
    (r"^Home Bargains", "Home Bargains"),
    (r"^Honest Burger", "Honest Burger"),
    (r"^Itsu", "Itsu"),
    (r"^BUNS FROM HOME", "Buns From Home"),
    (r"BURGER KING", "Burger King"),
    (r"Bubble Pop", "Bubble Pop"),
    (r"UKVI", "UK Visas and Immigration"),
    (r"CITIZENS ADVICE", "Citizens Advice"),
    (r"CITY OF LONDON ACADEMY", "City of London Academy"),
    (r"^COFFEE STATION", "Coffee station"),
    (r"^COSTA ", "COSTA "),
    (r"Creams Café", "Creams Café"),
    (r"Chidminder ", "Childminder "),
    (r"Dominos ", "Dominos Pizza"),
    (r"Dunelm", "Dunelm"),
    (r"Easyhotel ", "Easyhotel"),
    (r"Easyjet", "Easyjet"),
    (r"Escape Hunt ", "Escape Hunt"),
    (r"Expedia ", "Expedia"),
    (r"^GWR ", "Great Western Trains"),
    (r"HALFORDS ", "Halfords"),
    (r"HOME START", "Home Start"),
    (r"HOMESTART ", "Home Start"),
    (r"HUNGRY CATERPILLARS ", "Hungry Caterpillars"),
    (r"J D SPORTS ", "JD Sports "),
    (r"JD SPORTS ", "JD Sports"),
    (r"JD WETHERSPOON", "JD Wetherspoon"),
    (r"^KFC - ", "KFC"),
    (r"^KFC ", "KFC"),
    (r"LASTMINUTECOM ", "Lastminute.com "),
    (r"^LIDL GB ", "Lidl"),
    (r"^LIDL U", "Lidl"),
    (r"Linkedin ", "Linkedin "),
    (r"M&S SIMPLY ", "M & S Simply Food"),
    (r"M&S FOOD", "M & S Simply Food"),
    (r"MAIL BOXES ETC", "Mail Boxes Etc"),
    (r"MAILBOXES", "Mail Boxes Etc"),
    (r"MAJESTIC WIN", "Majestic Wine"),
    (r"^SAINSBURY'S", "Sainsburys"),
    (r"^SAINSBURYS", "Sainsburys"),
    (r"MARKS&SPENCER", "M & S Simply Food"),
    (r"MARKS & SPENCER", "M & S Simply Food"),
    (r"MARKSANDSPENCER", "M & S Simply Food"),
    (r"MARKS AND SPENCER", "M & S Simply Food"),
    (r"METROPOLIS EVENTS ", "Metropolis Events"),
    (r"^Mfg ", "Motor Fuel Group Petrol Station"),
    (r"NAME-CHEAP.COM ", "Name-Cheap.com"),
    (r"NANDOS", "Nandos"),
    (r"Netflix", "Netflix"),
    (r"NISA LOCAL ", "NISA Local"),
    (r"NOVOTEL ", "Novotel"),
    (r"NPOWER", "NPower"),
    (r"^O2", "O2"),
    (r"OCULUS", "Oculus"),
    (r"ODEON", "Odean Cinemas"),
    (r"OLE AND STEEN", "Ole & Steen"),
    (r"OPODO", "Opodo"),
    (r"PAYBYPHONE", "PayByPhone"),
    (r"PIZZA EXPRESS", "Pizza Express"),
    (r"PIZZAEXPRESS", "Pizza Express"),
    (r"PIZZA HUT", "Pizza Hut"),
    (r"Post Office", "Post Office"),
    (r"POUNDSTRETCHER", "Pound Stretcher"),
    (r"PREMIER INN", "Premier Inn"),
    (r"PRET A MANGER", "Pret a manger"),
    (r"PREZZE", "Prezze"),
    (r"PRIMARK", "Primark"),
    (r"Prime Video", "Amazon Prime"),
    (r"RENTOKIL", "Rentokil"),
    (r"ROBERT DYAS", "Robert Dias"),
    (r"ROYAL MAIL", "Royal Mail"),
    (r"Ryanair", "Ryanair"),
    (r"S40 FOIA", "Freedom of Information S40"),
    (r"Screwfix", "Screwfix"),
    (r"Spotify", "Spotify"),
    (r"TESCO", "Tesco"),
    (r"THE SALVATION ARMY", "The Salvation Army"),
    (r"Thomson Reuters", "Thomson Reuters"),
    (r"TRAVELODG", "Travelodge"),
    (r"TRAVIS PERKINS", "Travis Perkins"),
    (r"TSGN", "Thameslink, Southern and Great Northern railway"),
    (r"UNIQLO", "Uniqlo"),
    (r"URBAN OUTFITTERS", "Urban Outfitters"),
    (r"VEOLIA", "Veolia ES Ltd"),
    (r"VODAFONE", "Vodaphone Ltd"),
    (r"WELCOME BREAK", "Welcome Break"),
    (r"^WICKES ", "Wickes"),
    (r"^Wordpress", "Wordpress"),
    (r"YMCA ", "YMCA "),
    (r"ZIPCAR", "Zipcar Ltd"),
    (r"ZIZZI", "Zizzi"),
    (r"lastminute", "lastminute.com"),
    (r"revolut", "revolut"),
    (r"COOP\b", "CoOp Supermarket"),
    (r"^Asda Express", "Asda Supermarket Ltd"),
    (r"^Asda George", "Asda George Online"),
    (r"^Asda Groceries", "Asda Supermarket Ltd"),
    (r"^Asda Petrol", "Asda Petrol"),
    (r"^Asda Superstor", "Asda Supermarket Ltd"),
    (r"^Asda\b", "Asda Supermarket Ltd"),
]
#: Headers (lower case, without currency signs) and the target they stand for where no mapping sheet tells.
HEADER_TARGETS = {
    "payment date": "date", "payment_date": "date", "paymentdate": "date",
    "date": "date", "posting date": "date", "transaction date": "date",
    "trans date": "date", "date of transaction": "date", "entry date": "date",
    "paym acc date": "date", "actual payment date": "date",
    "payment date - g/l date": "date", "effective date": "date",
    "invoice date": "date",
    "date incurred -payment date": "date", "date incurred - payment date": "date",
    "date incurred- payment date": "date", "3. date incurred": "date",
    "4. date paid": "date", "order date": "date",
    "period": "date",

    "amount": "amount", "net amount": "amount", "net value": "amount",
    "payment amount": "amount", "transaction amount": "amount",
    "trans original net amt": "amount",
    "amount (excl vat)": "amount", "amount (ex vat)": "amount",
    "amount (excluding vat)": "amount",
    "expenditure amount (exc vat)": "amount",
    "distribution amount": "amount", "distrib amount sum": "amount",
    "invoice line amount": "amount", "invoice amount": "amount",
    "spend (excluding vat)": "amount", "spend (excluding vat": "amount",
    "3 spend (excluding vat)": "amount",
    "net": "amount", "total": "amount", "sum of amount": "amount",
    "amount gbp": "amount", "net amounte": "amount",

    "gross": "amount_formula", "gross value": "amount_formula",
    "gross amount": "amount_formula", "gross invoice value": "amount_formula",

    "vat": "vat", "vat value": "vat", "vat amount": "vat", "vat amt": "vat",
    "non recoverable vat": "vat", "non-recoverable vat": "vat",
    "non recurring vat": "vat",
    "non recoverable": "vat", "unclaimed vat": "vat",
    "irrecoverable vat": "vat", "irrecoverable vat amount gbp": "vat",
    "irrecoverablevatamount": "vat", "tax": "vat",

    "supplier name": "supplier", "supplier": "supplier",
    "beneficiary": "supplier", "beneficiaryname": "supplier",
    "beneficiary name": "supplier", "payee": "supplier",
    "vendor name": "supplier", "vendor": "supplier",
    "creditor_name": "supplier", "supplier name *******": "supplier",
    "merchant name": "supplier", "published supplier name": "supplier",
    "supplier (beneficiary) name": "supplier", "5. beneficiary": "supplier",
    "updated beneficiary": "supplier", "reported beneficiary": "supplier",
    "final supplier name": "supplier", "name": "supplier",
    "amended supplier name": "supplier", "suppliername": "supplier",
    "vendor name 2": "supplier",
    "supplier_name": "supplier", "supplier_name_redacted": "supplier",
    "supplier description": "supplier",

    "department": "department", "directorate": "department",
    "local authority department": "department", "la department": "department",
    "organisationalunit": "department", "organisational unit": "department",
    "organisation unit": "department", "organisation": "department",
    "division": "department", "cclvl4 desc": "department",
    "cost centre hierarchy - department": "department",
    "cost centre hierarchy - directorate": "department",
    "cost centre description": "department",
    "cost centre / department": "department",
    "directorate / service where expenditure incurred": "department",
    "service area categorisation": "department",
    "7. department": "department", "expense area": "department",
    "division of service": "department",
    "portfolio": "department", "new portfolio": "department",
    "directorate code": "department",

    "expense type": "expense_type", "expenditure type": "expense_type",
    "expenditure category": "expense_type",
    "expenditure category/description": "expense_type",
    "purpose": "expense_type", "purpose of expenditure": "expense_type",
    "purpose_of_spend": "expense_type",
    "8. purpose of expenditure": "expense_type",
    "activity": "expense_type", "subjective description": "expense_type",
    "subjective desctiption": "expense_type",
    "account desc": "expense_type", "account description": "expense_type",
    "summary of purpose": "expense_type", "description": "expense_type",
    "nominal description": "expense_type",
    "gl account description": "expense_type",
    "code description": "expense_type",
    "updated code description": "expense_type",
    "provided goods & services": "expense_type",
    "trans cac desc 1": "expense_type",
    "material group description": "expense_type",
    "expenses type": "expense_type", "spend type": "expense_type",
    "proclass category": "expense_type",
    "category/purpose": "expense_type", "category purpose": "expense_type",
    "subj_description": "expense_type", "subjective group": "expense_type",
    "subjective": "expense_type",
    "bvsub description": "expense_type", "bvsum description": "expense_type",
    "classification description": "expense_type",

    "service": "service_area", "service area": "service_area",
    "service_area": "service_area",
    "service label": "service_area", "servicecategorylabel": "service_area",
    "service category label": "service_area",
    "service area/capital project description": "service_area",
    "trans cac desc 2": "service_area",
    "cat1": "service_area",
    "bvsub category": "service_area", "service code": "service_area",

    "supplier category": "supplier_category",
    "vendor type": "supplier_category", "vendor_type": "supplier_category",
    "vendor_type_lookup_code": "supplier_category",
    "merchant category": "supplier_category",
    "categoryinternalname": "supplier_category",
    "9. merchant category": "supplier_category",
    "category": "supplier_category",
    "classification code": "supplier_category",

    "transaction number": "txn_id", "transactionnumber": "txn_id",
    "transaction_number": "txn_id",
    "transno": "txn_id", "transaction no": "txn_id", "trans no": "txn_id",
    "payment number": "txn_id", "payment reference number": "txn_id",
    "payment_number": "txn_id",
    "reference": "txn_id", "unique reference": "txn_id",
    "supplier number": "txn_id", "supplier no": "txn_id",
    "supplier id": "txn_id", "supplierid": "txn_id",
    "supplier_number": "txn_id",
    "vendor id": "txn_id", "sap vendor number": "txn_id",

    "payment type": "payment_type_col",
    "card_transaction": "payment_type_col",
    "card transaction": "payment_type_col",
}
#: Header under which a publisher's suppliers may be blank or one character.
EALING_EXEMPT_HEADER = (
    "Body Name", "Organisation Code", "Service Label", "Service Code",
    "Organisation Unit", "Expenditure Category", "Expenditure Code",
    "Narrative", "Date", "Transaction No", "Net Amount", "Supplier Id",
    "Amended Supplier Name",
)
#: Files (publisher, lower-case name) whose header is known, and files whose first row is their header.
CARD_HEADER = ["POSTING DATE", "TRANSACTION AMOUNT", "MERCHANT NAME", "DESCRIPTION"]
CARD_HEADER_2024 = ["Date", "Merchant Name", "Transaction Amount", "Description"]
TAB_CARD_HEADER = ["TRANS DATE", "TRANS ORIGINAL NET AMT", "TRANS CAC DESC 1", "MERCHANT NAME", "TRANS CAC DESC 2"]
CARD_FILES = [
    "april_2022_-_credit_card.xlsx",
    "april_2023_to_february_2024_credit_card_spend.xlsx",
    "august_2022_-_credit_card.xlsx",
    "december_2022_-_credit_card.xlsx",
    "february_2023_-_credit_card.xlsx",
    "january_2023_-_credit_card.xlsx",
    "july_2022_-_credit_card.xlsx",
    "june_2022_-_credit_card.xlsx",
    "march_2023_-_credit_card.xlsx",
    "may_2022_-_credit_card.xlsx",
    "november_2022_-_credit_card.xlsx",
    "october_2022_-_credit_card.xlsx",
    "september_2022_-_credit_card.xlsx",
]
CARD_FILES_2024 = ["credit_card_spend_april_2024_-_november_2024.xlsx"]
AS_IS_FILES = [
    ("greenwich", "greater than £500 qtr 2 jul to sep 25-26 final for publishing.xlsx"),
    ("greenwich", "greater_than___500_qtr_3_oct_to_dec_23_24_final_for_publishing.xlsx"),
    ("greenwich", "payments_over_500_qtr_3_oct_to_dec_24_25.xlsx"),
    ("southwark", "council spending january 2024.xlsx"),
]
TAB_FILES = ["pcard-aug-2025.xlsx"]
EXPORT_WORDS = ("export", "download all", "csv")
HEADERLESS = {True: "<< unreadable or empty >>", False: "<< no header detected >>"}
NAME_COUNTRIES = [
    "United Kingdom", "United States", "Ireland", "Canada", "Australia", "Nigeria", "Ghana", "Kenya", "South Africa", "Somalia", "India", "Pakistan", "Bangladesh", "Sri Lanka",
    "Jamaica", "Trinidad and Tobago", "Poland", "Romania", "Portugal", "Spain", "France", "Italy", "Germany", "Greece", "Lithuania", "Bulgaria", "China", "Hong Kong",
    "Philippines", "Malaysia", "Singapore", "Turkey", "Iran, Islamic Republic of", "Iraq", "Afghanistan", "Brazil", "Colombia", "Mexico",
]
NAME_RANK_MAX = 45000
FINAL_STATES = ["SUCCEEDED", "PARTIALLY_SUCCEEDED", "FAILED", "CANCELLED", "EXPIRED"]
RESULT_STATES = ["SUCCEEDED", "PARTIALLY_SUCCEEDED"]
SKIPPED_FOLDERS = [".git", "node_modules", "__pycache__", ".venv", "venv", ".mypy_cache", ".pytest_cache", ".ipynb_checkpoints"]
# --- end of fixed values ------------------------------------------------------------------------------------------
