"""The Dutch small-business rules.

Every term is a pattern fragment matched between word boundaries in
lower-cased text.
"""

from newsloom.operators.rules import NOT_SME, SME, Rule

# The terms below decide the votes and have to be exactly these.

EXPLICIT_SME = (
    "mkb",
    "midden- en kleinbedrijf",
    "kmo",
    "kleine onderneming",
    "kleine bedrijven",
    "small and medium enterprise",
    "mkb-ondernemers?",
    "mkb-bedrijven?",
    "mkb-sector",
    "mkb'er(s)?",
    "ondernemersvereniging",
    "ondernemersloket",
)

GENERIC_BUSINESS = (
    r"(klein(e|er)e?\s+)?bedrijf(fen)?",
    "onderneming(en)?",
    "zaak",
    "zaken",
    "ondernemingshuis",
    "ondernemersloket",
    "bedrijfsleven",
    r"organisatie(s)?\s+(in\s+de\s+)?(regio|provincie|gemeente)",
    "bedrijfstak",
    "bedrijfssector",
)

AGRICULTURE = (
    "landbouw", "akkerbouw", "tuinbouw", "bosbouw", "visserij", "kwekerij", "veeteelt", "pluimvee", "fishing",
    "farm(er|ing)", "agriculture", "greenhouse", "forestry",
)
INDUSTRY = (
    "industrie", "fabriek(en)?", "productiebedrijf", "manufacturing", "energiebedrijf", "energy supply",
    "energievoorziening", "waterbedrijf", "watermaatschappij", "afvalbeheer", "recycling", "waste management",
    "milieudienst",
)
CONSTRUCTION = (
    "bouwbedrijf", "bouwnijverheid", "aannemer(s)?", "installatiebedrijf", "constructie", "bouwsector", "bouwvakker",
)
RETAIL = (
    "handel", "detailhandel", "groothandel", "winkel", "supermarkt", "bakker(ij)?", "slager(ij)?", "kapsalon",
    "drogisterij", "webwinkel", "e-commerce", "shop", "store",
)
TRANSPORT = (
    "transport(bedrijf)?", "vervoer", "logistiek", "koerier(s)?", "magazijn", "opslag", "distributiecentrum",
    "transport and storage",
)
HOSPITALITY = ("horeca", "restaurant", "café", "bar", "hotel", "snackbar", "catering", "hospitality")
IT_MEDIA = (
    "ict", "it", "softwarebedrijf", "software company", "telecom", "mediabedrijf", "uitgeverij",
    "communicatiebureau", "cyberbedrijf", "cybersecurity", "digitale weerbaarheid", "digitale veiligheid",
    "informatiebeveiliging", "veilig ondernemen",
)
FINANCE = (
    "financiële dienstverlening", "boekhoud(kantoor)?", "accountantskantoor", "administratiekantoor",
    "verzekeringskantoor", "bank", "verzekeraar",
)
REAL_ESTATE = (
    "makelaar", "vastgoed", "real estate", "woningcorporatie", "onroerend goed", "property rental",
)
PROFESSIONAL = (
    "adviesbureau", "consultancy", "marketingbureau", "ingenieursbureau", "juridisch advies", "advocatenkantoor",
    "communicatieadvies", "specialist business services",
)
HEALTH_EDUCATION = (
    "school", "onderwijsinstelling", "training", "opleidingsinstituut", "kinderopvang", "basisschool",
    "middelbare school", "praktijk", "kliniek", "ziekenhuis", "zorginstelling", "fysiotherapie", "gezondheidszorg",
    "welzijnszorg",
)
CULTURE = (
    "sportschool", "fitnesscentrum", "sportvereniging", "theater", "museum", "recreatiebedrijf",
    "cultureel centrum", "vereniging",
)
SECTORS = (
    *AGRICULTURE, *INDUSTRY, *CONSTRUCTION, *RETAIL, *TRANSPORT, *HOSPITALITY, *IT_MEDIA, *FINANCE,
    *REAL_ESTATE, *PROFESSIONAL, *HEALTH_EDUCATION, *CULTURE,
)

ENTREPRENEURSHIP = (
    "ondernemer", "ondernemers", "zelfstandige", "zelfstandigen", "zzp", "start-?up", "startups?",
    "ondernemerschap", "freelancer", "freelancers", "bedrijf starten", "bedrijf oprichten",
)

INTERNATIONAL_POLITICS = (
    "uk", "starmer", "russische aanval", "v.n.", "trump", "europa", "oorlog", "russia", "usa", "united states",
    "nato",
)

DOMESTIC_POLITICS = (
    "politiek", "partij", "stemmen", "verkiezing", "minister", "parlement", "partijleider", "raad", "gemeente",
    "beleid",
)

GOVERNMENT = (
    "ministerie", "departement", "justitie", "veiligheid", r"algemene\s+bestuursdienst",
    "directeur", "directie", "benoemd", "benoeming", "aanstelling",
    "functie", "carrière", "vacature", r"nieuwe\s+positie", "chief", "officer",
    "bestuurder", "leidinggevende", "manager", "plaatsvervangend",
)

ACCIDENTS_CRIME = (
    "ongeluk", "drama", "ramp", "brand", "dood", "moord", "criminaliteit", "aanrijding", "botsing", "explosie",
    "verkrachting", "rellen",
)

CYBER_VICTIMS = ("mkb", "bedrijf", "ondernemer", "zaak", "organisatie")
CYBER_TERMS = (
    "cyber", "digitale", "phishing", "ransomware", "hack", "veiligheid", "weerbaarheid", "cybercrime",
)

SPORTS_ENTERTAINMENT = (
    "honkbal", "voetbal", "sport", "theater", "film", "serie", "muziek", "concert", "festival", "wedstrijden",
)

CRIME_VICTIMS = (
    "bedrijf", "onderneming", "zaak", "mkb", "ondernemer", "directeur", "werkgever", "adviesbureau",
)
BUSINESS_CRIMES = (
    "fraude", "oplichting", "witwassen", "corruptie", "diefstal", "verduistering", "afpersing",
    "valsheid in geschrifte", r"onderzoek\s+naar", "aangifte",
)

INSOLVENCY = ("failliet", "faillissement", "curator", "doorstart", "herstructurering")
INSOLVENCY_CRIMES = (
    "fraude", "oplichting", "witwassen", "corruptie", "diefstal", "verduistering", "aangifte", "onderzoek",
)

RULES = (
    Rule("lf_explicit_sme", SME, (EXPLICIT_SME,)),
    Rule("lf_generic_bedrijf", SME, (GENERIC_BUSINESS,)),
    Rule("lf_general_sector_terms", SME, (SECTORS,)),
    Rule("lf_generic_entrepreneurship", SME, (ENTREPRENEURSHIP,)),
    Rule("lf_international_politics", NOT_SME, (INTERNATIONAL_POLITICS,), active=False),
    Rule("lf_accidents_crime", NOT_SME, (ACCIDENTS_CRIME,)),
    Rule("lf_politics_domestic", NOT_SME, (DOMESTIC_POLITICS,)),
    Rule("lf_sme_cybercrime", SME, (CYBER_VICTIMS, CYBER_TERMS)),
    Rule("lf_sports_entertainment", NOT_SME, (SPORTS_ENTERTAINMENT,)),
    Rule("lf_business_crime", SME, (CRIME_VICTIMS, BUSINESS_CRIMES)),
    Rule("lf_bankruptcy_only", NOT_SME, (INSOLVENCY,), none_of=INSOLVENCY_CRIMES, active=False),
    Rule("lf_government_only", NOT_SME, (GOVERNMENT,)),
)
