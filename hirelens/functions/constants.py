"""Fixed values that must equal the reference's rules for equal results.

FIXED VALUES — keep them exactly as written, in this order.
"""

# Skill-chip tokens that are UI labels, locations or work types, not skills.
SKILL_NOISE = [
    "xem thêm", "nổi bật", "quyền lợi", "quyền lợi:",
    "hà nội", "hcm", "hồ chí minh", "đà nẵng",
    "toàn thời gian", "bán thời gian", "thực tập",
]

# City dictionary: lower-case key -> canonical name (dictionary order breaks
# ties between contained keys of equal length).
CITY_MAP = [
    ("hà nội", "Hà Nội"), ("ha noi", "Hà Nội"), ("hn", "Hà Nội"),
    ("hồ chí minh", "Hồ Chí Minh"), ("hcm", "Hồ Chí Minh"),
    ("tp hcm", "Hồ Chí Minh"), ("tp. hcm", "Hồ Chí Minh"),
    ("đà nẵng", "Đà Nẵng"), ("da nang", "Đà Nẵng"),
    ("cần thơ", "Cần Thơ"), ("hải phòng", "Hải Phòng"),
    ("bình dương", "Bình Dương"), ("đồng nai", "Đồng Nai"),
    ("remote", "Remote"), ("toàn quốc", "Toàn quốc"),
]

# Exact-match aliases of the live layer (its own spellings are replaced by
# the contract's canonical names above).
CITY_EXACT_ALIASES = [
    ("hanoi", "Hà Nội"),
    ("ho chi minh", "Hồ Chí Minh"),
    ("ho chi minh city", "Hồ Chí Minh"),
]

# Query parameters dropped by URL normalization (compared lower-case).
TRACKING_PARAMS = [
    "ta_source", "u_sr_id", "ref", "source",
    "utm_source", "utm_medium", "utm_campaign",
    "utm_content", "utm_term", "fbclid", "gclid",
]

# Employment type code -> Vietnamese label.
EMPLOYMENT_TYPES = [
    ("FULL_TIME", "Toàn thời gian"),
    ("PART_TIME", "Bán thời gian"),
    ("CONTRACTOR", "Hợp đồng"),
    ("INTERN", "Thực tập"),
    ("TEMPORARY", "Thời vụ"),
    ("OTHER", "Khác"),
]

# Level label -> code.
LEVELS = [
    ("Nhân viên", "staff"),
    ("Chuyên viên", "specialist"),
    ("Quản lý", "manager"),
    ("Trưởng nhóm", "lead"),
    ("Giám đốc", "director"),
]

# Blocked / empty page detection.
BLOCKED_HTML_SIGNALS = [
    "access denied", "forbidden", "captcha",
    "cf-browser-verification", "attention required", "robot",
]
BLOCKED_TITLE_SIGNALS = ["forbidden", "access denied", "captcha"]
BLOCKED_MIN_HTML_CHARS = 1000
BLOCKED_MIN_TEXT_CHARS = 300

# Salary rules.
NEGOTIABLE_WORDS = ["thỏa thuận", "thoả thuận"]
USD_TO_VND = 25000
VND_MILLION = 1000000

# Realtime settings.
STREAM_A_WATERMARK = "30 minutes"
STREAM_C_WATERMARK = "10 minutes"
SPEED_VIEW_TTL_SECONDS = 7200
ROW_TTL_DAYS = 30
AGG_TTL_DAYS = 7
