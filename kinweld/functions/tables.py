"""Fixed values that decide results: aliases, priorities, reliabilities."""

from __future__ import annotations

# Logical field and the names it goes by, in order of preference.
ALIASES: dict[str, tuple[str, ...]] = {
    "full_name": ("full_name", "name", "candidate_name", "displayName"),
    "emails": ("emails", "email", "email_address", "contact.email"),
    "phones": ("phones", "phone", "phone_number", "mobile", "contact.phone"),
    "headline": ("headline", "title", "current_title", "summary"),
    "years_experience": ("years_experience", "experience_years", "total_experience"),
    "skills": ("skills", "technical_skills", "skill_set"),
    "experience": ("experience", "work_experience", "employment"),
    "education": ("education", "academic_history"),
    "location": ("location", "address"),
    "linkedin": ("linkedin", "linkedin_url", "links.linkedin"),
    "github": ("github", "github_url", "links.github"),
    "portfolio": ("portfolio", "website", "personal_url", "links.portfolio"),
}

# Country and skill spellings.
COUNTRY_ALIASES = {"uk": "GB", "u.k.": "GB", "great britain": "GB", "us": "US", "u.s.": "US", "u.s.a.": "US", "united states of america": "US"}
SKILL_ALIASES = {
    "cpp": "C++", "c plus plus": "C++", "c++": "C++",
    "reactjs": "React", "react.js": "React", "react": "React",
    "nodejs": "Node.js", "node.js": "Node.js",
    "js": "JavaScript", "javascript": "JavaScript",
    "ts": "TypeScript", "typescript": "TypeScript",
    "py": "Python", "python": "Python",
    "postgres": "PostgreSQL", "postgresql": "PostgreSQL",
    "aws": "AWS", "amazon web services": "AWS",
    "ml": "Machine Learning", "machine learning": "Machine Learning",
}

# Sources by priority, and how far sources and methods are trusted.
SOURCE_RANK = {"resume": 0, "linkedin": 1, "ats": 2, "csv": 3, "github": 4}
UNKNOWN_RANK = 99
SOURCE_RELIABILITY = {"resume": 0.95, "linkedin": 0.92, "ats": 0.85, "csv": 0.75, "github": 0.70}
UNKNOWN_SOURCE = 0.6
METHOD_RELIABILITY = {"structured_json": 0.98, "structured_column": 0.95, "mapped_field": 0.90, "regex": 0.82, "header_heuristic": 0.78, "section_heuristic": 0.76, "stable_hash": 1.0, "calculated": 0.95}
UNKNOWN_METHOD = 0.70
FIELD_WEIGHTS = {"full_name": 1.2, "emails": 1.4, "phones": 1.2, "links": 1.0, "location": 0.7, "headline": 0.6, "years_experience": 0.8, "skills": 1.0, "experience": 1.1, "education": 0.9}

# Order of fields in provenance, namespace of profile ids.
EVIDENCE_ORDER = ("full_name", "emails", "phones", "headline", "years_experience", "skills", "location", "links", "experience", "education", "candidate_id")
ID_NAMESPACE = "71518fe1e18d49aea2bc77b83ae43217"

# Headings of a resume.
SECTIONS = ("skills", "technical skills", "experience", "work experience", "education", "summary", "profile")

# Region, calling code, trunk prefix, shortest and longest
# national number. North America has its own rule.
NUMBERING = (
    ("GB", "44", "0", 9, 10), ("IN", "91", "0", 10, 10), ("DE", "49", "0", 6, 11), ("FR", "33", "0", 9, 9), ("ES", "34", "", 9, 9),
    ("IT", "39", "", 8, 11), ("NL", "31", "0", 9, 9), ("BE", "32", "0", 8, 9), ("CH", "41", "0", 9, 9), ("AT", "43", "0", 7, 13),
    ("SE", "46", "0", 7, 9), ("NO", "47", "", 8, 8), ("DK", "45", "", 8, 8), ("FI", "358", "0", 6, 11), ("IE", "353", "0", 8, 9),
    ("PT", "351", "", 9, 9), ("PL", "48", "", 9, 9), ("CZ", "420", "", 9, 9), ("GR", "30", "", 10, 10), ("RU", "7", "8", 10, 10),
    ("UA", "380", "0", 9, 9), ("TR", "90", "0", 10, 10), ("IL", "972", "0", 8, 9), ("AE", "971", "0", 8, 9), ("SA", "966", "0", 8, 9),
    ("ZA", "27", "0", 9, 9), ("NG", "234", "0", 8, 10), ("KE", "254", "0", 9, 9), ("EG", "20", "0", 8, 10), ("CN", "86", "0", 10, 11),
    ("JP", "81", "0", 9, 10), ("KR", "82", "0", 8, 10), ("SG", "65", "", 8, 8), ("MY", "60", "0", 8, 10), ("TH", "66", "0", 8, 9),
    ("VN", "84", "0", 9, 10), ("PH", "63", "0", 8, 10), ("ID", "62", "0", 8, 11), ("PK", "92", "0", 9, 10), ("BD", "880", "0", 8, 10),
    ("AU", "61", "0", 9, 9), ("NZ", "64", "0", 8, 10), ("BR", "55", "0", 10, 11), ("MX", "52", "", 10, 10), ("AR", "54", "0", 10, 10),
    ("CL", "56", "", 9, 9), ("CO", "57", "", 8, 10), ("PE", "51", "0", 8, 9), ("HK", "852", "", 8, 8), ("TW", "886", "0", 8, 9),
)
NANP = r"[2-9]\d{2}[2-9]\d{6}"

# Country names that English Locale data spells otherwise.
COUNTRY_NAMES = {"czech republic": "CZ", "ivory coast": "CI", "russian federation": "RU", "viet nam": "VN", "korea, republic of": "KR", "bolivia, plurinational state of": "BO", "iran, islamic republic of": "IR", "venezuela, bolivarian republic of": "VE", "tanzania, united republic of": "TZ", "moldova, republic of": "MD", "syrian arab republic": "SY", "taiwan, province of china": "TW", "holland": "NL", "england": "GB", "scotland": "GB", "wales": "GB"}
