"""Word lists for text columns.

Lists marked FIXED carry the source's own values; the others are ours (the source drew from a
third-party fake-data library, which we do not use).
"""

# --- FIXED values (must equal the source) ----------------------------------------------------
# username patterns, drawn with equal probability
USERNAME_PATTERNS = ("first_last", "firstlast", "first_last_##", "hobby_first", "first_##", "realname")
# hobby prefixes
HOBBIES = ("photo", "video", "art", "music", "sport", "game", "cook", "travel")
# post kinds, drawn with equal probability, and their title templates
POST_KINDS = ("Update", "Thoughts", "Video Share", "Photo Share", "Link Share",
              "Question", "Achievement", "Opinion", "Story", "Meme")
TITLE_VIDEO = "Just watched this amazing video: "
TITLE_PHOTO = ("Check out my ", " photo!")
TITLE_LINK = "Interesting article: "
TITLE_QUESTION = ("Quick question: ", "?")
TITLE_ACHIEVEMENT = ("Proud to announce: ", " milestone reached!")
TITLE_OPINION = ("My thoughts on ", ":")
TITLE_STORY = "Something happened today... "
TITLE_MEME = ("When ", " meets ", ":")
# body length classes: short 40 %, medium 40 %, long 20 %;
# short 5..14 words, medium 2..3 sentences, long 4..7 sentences
BODY_CLASSES = (("short", 0.4), ("medium", 0.4), ("long", 0.2))
# variant E's texts
E_TITLE = "Post about topic "
E_TITLE_VIDEO = " - VIDEO CONTENT"
E_VIRAL_OPEN = "Check out this amazing video! "
E_VIRAL_LINE = "This is incredible content that everyone is sharing. "
E_VIRAL_TAGS = " #viral #trending #mustwatch"
E_POST_OPEN = "User post "
E_POST_LINE = "Some interesting content here. "
E_POST_TAG = " #discussion"
# -----------------------------------------------------------------------------------------------

FIRST_NAMES = (
    "ada", "ben", "cora", "dev", "elena", "finn", "gia", "hugo", "iris", "jonas", "kai", "lena",
    "milo", "nora", "omar", "pia", "quinn", "rosa", "sami", "tara", "uma", "vik", "wren", "xena",
    "yara", "zane", "aria", "bruno", "chloe", "dario", "esme", "felix", "greta", "hana", "ivo",
    "jade", "kian", "lola", "mara", "nico",
)
LAST_NAMES = (
    "alder", "brook", "cole", "dunn", "ellis", "frost", "grant", "hale", "irwin", "joyce", "keane",
    "lund", "moss", "nash", "olsen", "price", "quade", "reyes", "stone", "tate", "upton", "vance",
    "wells", "yates", "zeller", "adler", "banks", "cruz", "drake", "evans", "flynn", "gomez",
    "hayes", "ives", "kerr", "lowe", "marsh", "noble", "ortiz", "park",
)
COLORS = (
    "amber", "azure", "beige", "coral", "crimson", "cyan", "gold", "indigo", "ivory", "jade",
    "lilac", "magenta", "navy", "olive", "peach", "plum", "rust", "teal", "violet", "white",
)
NOUNS = (
    "sunset", "garden", "bridge", "street", "mountain", "river", "coffee", "kitchen", "festival",
    "market", "library", "harbor", "studio", "forest", "beach", "skyline", "meadow", "canyon",
    "village", "balcony", "workshop", "trail", "island", "lantern", "bicycle", "concert",
    "rooftop", "station", "orchard", "museum",
)
ADJECTIVES = (
    "adaptive", "seamless", "robust", "scalable", "intuitive", "dynamic", "modular", "secure",
    "vertical", "virtual", "open", "smart", "agile", "unified", "balanced", "focused", "integrated",
    "proactive", "resilient", "streamlined",
)
CONCEPTS = (
    "platform", "framework", "workflow", "network", "pipeline", "strategy", "interface",
    "paradigm", "ecosystem", "toolkit", "roadmap", "dashboard", "solution", "initiative",
    "architecture", "community", "portfolio", "channel", "model", "service",
)
VERBS = (
    "empower", "leverage", "streamline", "transform", "unlock", "scale", "reinvent", "orchestrate",
    "accelerate", "cultivate", "optimize", "integrate", "deliver", "simplify", "engage",
    "monetize", "redefine", "synthesize", "deploy", "curate",
)
JOBS = (
    "graphic designer", "data analyst", "nurse", "teacher", "software engineer", "chef",
    "architect", "photographer", "pilot", "librarian", "carpenter", "pharmacist", "journalist",
    "electrician", "veterinarian", "accountant", "barista", "geologist", "translator",
    "mechanic", "dentist", "florist", "economist", "gardener", "paramedic",
)
# sentence vocabulary; a prime length gives every stride a full cycle
VOCAB = (
    "the", "a", "day", "time", "people", "way", "world", "life", "work", "new", "good", "first",
    "last", "long", "great", "little", "own", "other", "old", "right", "big", "high", "small",
    "large", "next", "early", "young", "important", "few", "public", "same", "able", "city",
    "night", "story", "music", "video", "friend", "moment", "idea", "team", "place", "home",
    "light", "water", "road", "game", "photo", "share", "watch", "love", "think", "find", "know",
    "make", "see", "feel", "try", "leave", "call", "today", "really", "always", "never",
    "together", "again", "almost",
)
assert len(VOCAB) == 67
