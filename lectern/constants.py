"""Results are only right when these equal the published ones."""

# --- fixed values: subjects ------------------------------------------------
REQUEST_SUBJECTS = (
    "matematik", "fizik", "kimya", "biyoloji", "tarih", "cografya",
    "felsefe", "din", "edebiyat", "ingilizce", "genel",
)

# --- fixed values: record contract -----------------------------------------
REQUIRED_KEYS = ("instruction", "input", "output", "subject", "grade")
OUTPUT_CHARS = (20, 1000)
RECORD_GRADES = (9, 12)
QUESTION_CHARS = (5, 500)
REQUEST_GRADES = (1, 12)
UPLOAD_SUFFIXES = (".pdf", ".txt")
UPLOAD_BYTES = 10 * 1024 * 1024
TITLE_CHARS = 200

# --- fixed values: answer checks -------------------------------------------
WEAK_ANSWER_CHARS = 50
MAX_ATTEMPTS = 3
WEAK_PHRASES = (
    "bilmiyorum",
    "yeterli bilgi yok",
    "emin değil",
    "veriliş bilgilere göre değerlendirme yapamıyorum",
    "bağlamda yer almıyor",
)
# phrases added by the later design, used with a score threshold of 0.7
EXTENDED_WEAK_PHRASES = WEAK_PHRASES + (
    "bilgi bulunmamaktadır",
    "kaynaklar yetersiz",
    "değerlendirme yapamıyorum",
    "veri yok",
)
LOW_SCORE = 0.7

# --- fixed values: citation patterns (Java syntax) ---------------------------
ACADEMIC_PATTERN = r"(?U)\b[A-ZÇĞİÖŞÜ][a-zçğıöşü]+(?:,\s+[A-ZÇĞİÖŞÜ]\.)?\s+\(\d{4}\)"
SOURCES_HEADER = r"(?imUd)^\s*#{1,4}\s*Kaynaklar?\s*:?\s*$|^\s*\*\*Kaynaklar?\*\*\s*:?\s*$"
# strict switch: also takes the colon inside the bold markers
SOURCES_HEADER_STRICT = SOURCES_HEADER + r"|^\s*\*\*Kaynaklar?\s*:\s*\*\*\s*$"
NEXT_HEADER = r"(?mUd)^\s*#{1,6}\s+\S"
FILE_NAME_PATTERN = r"(?iU)\b([\w\-]+\.(?:txt|pdf|md|docx?))\b"

# --- fixed values: index -----------------------------------------------------
CHUNK_CHARS = 500
CHUNK_OVERLAP = 50
SEPARATORS = ("\n\n", "\n", ". ", "? ", "! ", "; ", " ", "")
POINT_NAMESPACE = "a3c4f1d2-7890-4abc-def0-1234567890ab"
UNKNOWN_DOC = "<bilinmiyor>"
TOP_K = 4
KEYWORDS = (
    "tanzimat", "ferman", "1839", "abdülmecid", "modernleşme", "newton",
    "fizik", "kuvvet", "ivme", "eylemsizlik", "tarih", "matematik",
    "edebiyat", "şair", "yasa", "hareket",
)

# --- fixed values: wordings that results contain -------------------------------
QUESTION_LABEL = "SORU: "
CONTEXT_LABEL = "BAĞLAM:\n"
NO_CONTEXT_NOTE = "(Not: İlgili bağlam bulunamadı. Yeterli bilgi yoksa söyle.)"
RECORD_QUESTION_LABEL = "Soru: "
RECORD_ANSWER_LABEL = "Cevap: "
SCOPE_WORDS = " dersinde "
NOTHING_FOUND = "ilgili materyal bulunamadı."

# --- fixed values: reply fence, and what makes a question one of math (Java syntax) ---
JSON_FENCE = r"```(?:json)?\s*(\[[\s\S]*?\])\s*```"
MATH_PATTERN = r"\d|=|²|³|(?iU)türev|integral|denklem"

# --- fixed values: preparation and evaluation ---------------------------------
NEAR_DUPLICATE_COSINE = 0.95
EVAL_RATIO = 0.2
SEED = 42
MIN_RECORDS = 10
MIN_QUOTA = 5
ROUGE_L_BANDS = (0.25, 0.40)
BERT_F1_BANDS = (0.60, 0.75)
CHAT_OVERHEAD_TOKENS = 20
MAX_SEQUENCE_TOKENS = 512
SHORT_CHARS, LONG_CHARS = 100, 900
HISTOGRAM_BINS = 30
DAILY_QUESTIONS, DAILY_DOLLARS = 50, 0.10
PAGE_GOOD_SHARE = 0.60
LAST_MESSAGES = 5

# --- fixed values: curriculum, subject -> grade -> topics ----------------------
CURRICULUM = {
    "matematik": {
        9: ["kümeler", "denklemler ve eşitsizlikler", "mutlak değer", "üslü ifadeler", "üçgenler"],
        10: ["fonksiyonlar", "polinomlar", "ikinci dereceden denklemler", "dörtgenler", "olasılık"],
        11: ["logaritma", "diziler", "limit ve süreklilik", "türev uygulamaları", "analitik geometri"],
        12: ["integral", "trigonometri", "karmaşık sayılar", "matrisler", "istatistik ve veri analizi"],
    },
    "fizik": {
        9: ["fizik bilimine giriş", "madde ve özellikleri", "hareket", "kuvvet", "enerji"],
        10: ["elektrik ve manyetizma", "basınç ve kaldırma kuvveti", "dalgalar", "optik"],
        11: ["vektörler", "kuvvet ve hareket", "elektriksel kuvvet ve alan", "manyetizma"],
        12: ["düzgün çembersel hareket", "basit harmonik hareket", "dalga mekaniği", "atom fiziği"],
    },
    "kimya": {
        9: ["atom modelleri", "periyodik sistem", "kimyasal türler arası etkileşimler", "maddenin halleri"],
        10: ["karışımlar", "asitler ve bazlar", "tuzlar", "kimya her yerde"],
        11: ["modern atom teorisi", "gazlar", "sıvı çözeltiler", "kimyasal tepkimelerde enerji"],
        12: ["kimya ve elektrik", "karbon kimyası", "organik bileşikler", "enerji kaynakları"],
    },
    "biyoloji": {
        9: ["yaşam bilimi", "hücre", "canlıların çeşitliliği", "canlılarda enerji dönüşümleri"],
        10: ["hücre bölünmeleri", "kalıtımın genel ilkeleri", "ekosistem ekolojisi"],
        11: ["insan fizyolojisi", "denetleyici ve düzenleyici sistemler", "duyu organları"],
        12: ["genden proteine", "biyoteknoloji ve gen mühendisliği", "komünite ve popülasyon ekolojisi"],
    },
    "tarih": {
        9: ["İslam öncesi Türk devletleri", "İlk Çağ uygarlıkları", "İlk Türk-İslam devletleri"],
        10: ["Osmanlı kuruluş dönemi", "Osmanlı yükseliş dönemi", "Avrupa'da yeni çağ"],
        11: ["Osmanlı duraklama ve gerileme", "Tanzimat dönemi", "I. ve II. Meşrutiyet"],
        12: ["Kurtuluş Savaşı", "Atatürk ilke ve inkılapları", "Soğuk Savaş", "Çağdaş Türkiye tarihi"],
    },
    "cografya": {
        9: ["coğrafyaya giriş", "harita bilgisi", "iklim ve hava olayları", "yer şekilleri"],
        10: ["nüfus ve göç", "ekonomik faaliyetler", "Türkiye'nin konumu ve özellikleri"],
        11: ["biyoçeşitlilik", "doğal afetler", "uluslararası ulaşım ağları"],
        12: ["bölgesel kalkınma", "çevre ve toplum", "küresel sorunlar ve çözüm yolları"],
    },
    "felsefe": {
        10: ["felsefeye giriş", "bilgi felsefesi", "bilim felsefesi"],
        11: ["varlık felsefesi", "ahlak felsefesi", "siyaset felsefesi"],
        12: ["sanat felsefesi", "din felsefesi", "çağdaş felsefe akımları"],
    },
    "edebiyat": {
        9: ["edebiyata giriş", "hikaye türü", "şiir türü", "destan ve masal"],
        10: ["İslamiyet öncesi Türk edebiyatı", "Divan edebiyatı", "Halk edebiyatı"],
        11: ["Tanzimat edebiyatı", "Servet-i Fünun edebiyatı", "Milli Edebiyat dönemi"],
        12: ["Cumhuriyet dönemi Türk edebiyatı", "roman", "tiyatro", "çağdaş Türk şairleri"],
    },
    "ingilizce": {
        9: ["present/past simple tenses", "describing people and places", "daily routines",
            "countries and nationalities"],
        10: ["modals", "past continuous", "future plans", "reported speech basics"],
        11: ["perfect tenses", "passive voice", "conditionals", "phrasal verbs"],
        12: ["advanced grammar", "academic writing", "idioms", "literary analysis"],
    },
}
