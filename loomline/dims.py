"""Rule tables. All are defaults: every operator takes its table as a parameter."""

# Source tiers, tested in this order by containment, case-insensitively.
SOURCE_TIERS = [
    (1, ["Bloomberg"]),
    (2, ["FT", "Financial Times"]),
    (3, ["WSJ", "Wall Street Journal"]),
    (4, ["Reuters"]),
    (5, ["Big Tech", "TechCrunch", "TheVerge", "CNBC"]),
    (6, ["US Real Estate"]),
    (101, ["Korean Economy", "한국경제", "Hankyung"]),
    (102, ["Infomax"]),
    (103, ["Naver Finance"]),
]
OTHER_DOMESTIC, OTHER_FOREIGN, NO_SOURCE = 199, 99, 999

# Publishers by trust, tested in this order by containment.
TRUSTED_PUBLISHERS = ["Bloomberg", "Reuters", "Wall Street Journal", "Financial Times", "Chosun Ilbo", "Dong-A Ilbo", "Maeil Business", "Korea Economic Daily", "Yonhap Infomax"]

# Canonical publisher names: (name, contained, equal).
PRESS_NAMES = [
    ("Bloomberg", ["bloomberg"], []),
    ("Reuters", ["reuters"], []),
    ("WSJ", ["wall street journal"], ["wsj"]),
    ("FT", ["financial times"], ["ft"]),
    ("AP", ["ap news"], ["ap"]),
    ("TechCrunch", ["techcrunch"], []),
]

# Category codes in display order, with their names.
CATEGORIES = [
    ("G_mac", "Global > Macro"),
    ("G_mak", "Global > Market"),
    ("G_tech", "Global > Tech"),
    ("G_re", "Global > Region"),
    ("K_mac", "Korea > Macro"),
    ("K_mak", "Korea > Market"),
    ("K_in", "Korea > Industry"),
    ("Real_G", "Real Estate > Global"),
    ("Real_K", "Real Estate > Korea"),
]

# Words that drop a record, and tags in front of a title that do.
DROP_WORDS = [
    "영입", "주식뉴스", "이벤트", "주거급여", "청년월세", "난방비지원", "재난지원금", "바우처", "문화누리카드",
    "근로장려금", "자녀장려금", "지원금", "인도", "베트남", "브라질", "India", "Vietnam", "Brazil",
]
DROP_TAGS = ["포토", "속보", "개장", "마감", "1보", "2보", "3보", "상보", "부고", "인사", "동정", "행사", "알림", "모집"]

# Titles that are only a name or a section.
OUTLET_NAMES = ["Bloomberg", "bloomberg.com", "Reuters", "The Wall Street Journal", "WSJ", "Financial Times", "FT"]
SECTION_TITLES = [
    "Housing", "Sports", "Real Estate", "Economy", "Print Edition", "Wall Street Journal", "WSJ", "Markets", "Business",
    "Politics", "Opinion", "Technology", "Finance", "World", "US", "UK",
]

# Words that are no keywords.
KEYWORD_STOPS = [
    "의", "가", "이", "은", "는", "를", "을", "에", "와", "과", "로", "으로", "에서", "도", "만", "부터", "까지", "께서",
    "한테", "에게", "께", "더", "속", "및", "등", "중", "vs", "기대감", "우려", "전망",
]

# Names of domestic publishers, tested by containment in lower case.
DOMESTIC_PUBLISHERS = [
    "chosun", "dong-a", "joongang", "korea herald", "korea times", "maeil", "korea economic", "hankyung", "seoul economic",
    "asia economic", "financial news", "herald economy", "businesswatch", "the bell", "korea financial times", "seoul finance",
    "e-today", "newspim", "moneytoday", "yonhap", "infomax", "news1", "newsis", "genews", "edaily", "digital times",
    "electronic times", "zdnet", "bloter", "byline", "sbs", "mbn", "ytn", "mk news", "조선", "동아", "중앙", "한국경제",
    "매일경제", "매경", "한경", "서울경제", "아경", "아시아경제", "파이낸셜뉴스", "헤럴드경제", "비즈니스워치", "더벨", "한국금융",
    "서울파이낸스", "이투데이", "뉴스핌", "머니투데이", "이데일리", "연합", "인포맥스", "뉴스1", "뉴시스", "전자신문", "디지털타임스",
    "지디넷", "블로터", "바이라인", "sbs비즈", "매경tv", "naver",
]

# Publishers that an English report does not cite, tested by containment in any letter case.
CITATION_BLOCKLIST = [
    "Chosun", "Chosunbiz", "Dong-A", "JoongAng", "Korea Herald", "Korea Times", "Maeil", "Korea Economic", "Hankyung", "Seoul Economic",
    "Asia Economic", "Financial News", "Herald Economy", "BusinessWatch", "The Bell", "Korea Financial Times", "Seoul Finance", "E-Today",
    "Newspim", "MoneyToday", "Yonhap", "Infomax", "News1", "Newsis", "GEnews", "Edaily", "Digital Times", "Electronic Times", "ZDNet Korea",
    "Bloter", "Byline Network", "SBS Biz", "MBN", "MK News", "YTN", "조선일보", "조선", "동아일보", "동아", "중앙일보", "중앙", "한국경제",
    "매일경제", "매경", "한경", "서울경제", "아경", "아시아경제", "파이낸셜뉴스", "헤럴드경제", "비즈니스워치", "더벨", "한국금융신문", "서울파이낸스",
    "이투데이", "뉴스핌", "머니투데이", "이데일리", "연합뉴스", "연합", "인포맥스", "뉴스1", "뉴시스", "전자신문", "디지털타임스", "지디넷코리아",
    "블로터", "바이라인네트워크", "SBS비즈", "매경TV",
]

# Parts of the names of query parameters that a cleaned address keeps.
KEPT_PARAMETERS = ["article_id", "office_id", "idxno", "id", "no", "seq"]
