"""The vocabulary of labels, headings, roles and kinds of output that the predicates look up.

Plain tables, one value a row, in natural order. Singular stands for both numbers where a table says so.
"""

#: Labels of whole lists of publications.
LIST_LABELS = [
    "publication",
    "publications",
    "selected publication",
    "selected publications",
    "notable publication",
    "notable publications",
    "research output",
    "research outputs",
    "representative works",
    "all publications",
    "all research output",
    "all research outputs",
    "research output per year",
    "research outputs per year",
    "publications per year",
    "publication overview",
    "research output overview",
    "conference presentations",
    "no publication",
    "no publications",
    "journal publications and reviews",
]

#: What a menu entry does, and to what (singular for both).
MENU_VERBS = ["view", "show", "load", "see", "browse"]
MENU_NOUNS = ["publication", "research output", "result"]

#: What stands before the colon of a label that isn't a work, and behind 'project:'.
OUTPUT_CATEGORIES = ["research output", "research outputs"]
OTHER_CATEGORIES = ["prize", "activity", "press/media"]
PROJECT_KINDS = ["knowledge transfer", "research project"]

#: Kinds of output (singular for both numbers), and what may follow in parentheses: None for nothing, "*" for anything.
OUTPUT_KINDS = [
    ("abstract", None),
    ("article", "*"),
    ("journal article", "*"),
    ("other article", "*"),
    ("review article", "*"),
    ("newspaper article", "*"),
    ("conference article", "*"),
    ("book", "author"),
    ("book", "editor"),
    ("book", "translator"),
    ("book", None),
    ("book or report", None),
    ("book chapter", "translator"),
    ("book chapter", None),
    ("chapter", None),
    ("chapter in edited book", "author"),
    ("chapter in an edited book", "author"),
    ("conference paper", "*"),
    ("conference proceeding", "*"),
    ("conference abstract", "*"),
    ("conference poster", "*"),
    ("invited conference paper", None),
    ("invited conference paper published in conference proceedings", None),
    ("other conference paper", None),
    ("other conference paper published in conference proceedings", None),
    ("conference paper published in conference proceedings", None),
    ("meeting abstract published in a journal", None),
    ("publication in refereed journal", None),
    ("publication in a refereed journal", None),
    ("publication in policy or professional journal", None),
    ("publication in a policy or professional journal", None),
    ("publication in news outlet", None),
    ("publication in a news outlet", None),
    ("publication in magazine", None),
    ("publication in a magazine", None),
    ("paper", None),
    ("working paper", None),
    ("working paper series", None),
    ("discussion paper", None),
    ("discussion paper series", None),
    ("policy or profession paper", None),
    ("preprint", None),
    ("letter", None),
    ("editorial", "journal"),
    ("editorial", None),
    ("editorial/preface", "journal"),
    ("editorial/preface", None),
    ("comment/debate", None),
    ("comment/debate/erratum", None),
    ("erratum", None),
    ("research book or monograph", "author"),
    ("edited book", "editor"),
    ("textbook", "author"),
    ("authored play, poem, novel, story", "book"),
    ("authored play, poem, novel, story", "book chapter or short passage"),
    ("translation of other's work", "article"),
    ("translation of other's work", "book"),
    ("translation of other's work", "chapter"),
    ("reference entry", None),
    ("entry for encyclopedia/dictionary", None),
    ("foreword/postscript", None),
    ("review of books or software", None),
    ("thesis/dissertation", None),
    ("theses/dissertations", None),
    ("doctoral thesis/dissertation", None),
    ("doctoral theses/dissertations", None),
    ("consulting or contract research report", None),
    ("other output", None),
    ("other contribution", None),
    ("presentation", None),
    ("poster", None),
    ("patent", "lu"),
    ("patent", "non-lu"),
    ("patent", None),
    ("exhibition", None),
    ("performance", None),
    ("performance and participation in exhibits", None),
    ("digital, visual or audio product", None),
    ("film", None),
    ("film/video", None),
    ("film or video", None),
    ("computer software or system", None),
    ("software", None),
    ("software or system", None),
    ("engineering, architectural, graphic designs", None),
    ("design", None),
    ("sound recording", None),
    ("artefact", None),
    ("composition", None),
    ("composition/music score", None),
    ("music score/composition", None),
    ("painting, sculpture, drawing, photograph", None),
    ("literary works", "translator"),
    ("literary works", None),
    ("creative and literary works, consulting reports and case studies", None),
    ("written teaching case study or extensive note", None),
    ("teaching case", None),
    ("teaching development grants", "tdg"),
    ("honours projects", "hp"),
    ("honors projects", "hp"),
    ("preregistration", None),
    ("protocol", None),
    ("item of media coverage", None),
]

#: Titles of pages and sections that stand where a name should.
PAGE_TITLES = [
    "404 not found",
    "academic staff",
    "academic rankings",
    "adjunct professors",
    "awards and honors",
    "awards and honours",
    "cityuhk scholars",
    "course taught",
    "courses taught",
    "current research",
    "dedicated to",
    "distinguished visiting professors",
    "dive into details",
    "faculty",
    "faculty & staff",
    "faculty and staff",
    "faculty member",
    "faculty members",
    "faculty staff",
    "honorary professor",
    "honorary professors",
    "honourary professor",
    "honourary professors",
    "google scholar",
    "not found",
    "orcid id",
    "our people",
    "page not found",
    "people",
    "personal profile",
    "political development",
    "posted in",
    "posted on",
    "research professors",
    "researchgate",
    "reset filters",
    "scholarship winners",
    "selected publications",
    "scopus author id",
    "staff",
    "staff profile",
    "students and alumni success stories",
    "work experience",
]

#: Headings of sections (singular for both numbers).
SECTION_HEADINGS = [
    "course taught",
    "dive into detail",
    "award",
    "departmental award",
    "scholarship",
    "scholarship award",
    "scholarship winner",
    "select publication",
    "selected publication",
    "profile",
    "personal profile",
    "staff profile",
    "link to profile",
    "link to the profile",
    "view to profile",
    "view to the profile",
]

#: Words of which collective roles consist; one of the nouns has to be among them.
ROLE_WORDS = (
    "academic academics adjunct affiliate and assistant associate chair clinical distinguished emeritus faculty fellow fellows global "
    "guest honorary honourary lecturer lecturers member members part professor professors reader readers research scholar scholars "
    "staff teaching time visiting"
).split()
ROLE_NOUNS = "academic academics faculty fellow fellows lecturer lecturers member members professor professors reader readers scholar scholars staff".split()

#: Words of running text; what bodies that employ people are called.
FUNCTION_WORDS = "a and for in of on that the then to with".split()
BODIES = ["dept", "dept.", "department", "school", "faculty", "college", "institute", "centre", "center"]

#: How news about people begins, and what they win or get.
NEWS_OPENINGS = [
    "congratulation",
    "congratulations",
    "guest visit",
    "guests visit",
    "visitor visit",
    "visitors visit",
    "promotion of",
    "welcome prof",
    "welcome professor",
    "welcome dr",
]
NEWS_OF_ANOTHER = ["graduate", "position"]
NEWS_PRIZES = ["award", "poster", "presentation", "symposium"]

#: Offices that a name may have caught, and posts that a title names.
OFFICES = ["prof", "professor", "lecturer", "reader", "dean", "faculty of law"]
POSTS = ["professor", "lecturer", "reader", "research fellow", "principal investigator", "dean", "director"]
BARE_TITLES = ["academic staff", "faculty", "faculty member", "staff"]
RISKY_APPOINTMENTS = ["emeritus", "retired", "former"]

#: Words and phrases of a biography.
BIOGRAPHY = ["biography", "currently", "joined", "received", "obtained", "earned", "worked", "whose", "he is", "she is", "he was", "she was"]
BIOGRAPHY_IN_TITLES = [*BIOGRAPHY, "where he", "where she", "they were", "his", "her"]

#: Ranks in front of a name; ranks without a subject, and what may stand before them.
NAME_RANKS = ["associate professor", "assistant professor", "professor", "prof", "dr", "ts", "ir"]
RANK_NOUNS = ["fellow", "instructor", "lecturer", "professor", "reader"]
RANK_MODIFIERS = [
    "adjunct",
    "assistant",
    "associate",
    "chair",
    "clinical",
    "distinguished",
    "emeritus",
    "honorary",
    "principal",
    "professorial",
    "research",
    "senior",
    "teaching",
    "visiting",
]
