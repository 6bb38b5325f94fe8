import random

import pytest

from freshet.llm.garbled import find_garbled, garbled_ids, restore, units

RIGHT = {
    "fr": "ajoute la clé étrangère dès l’arrivée du fichier à côté du réseau",
    "de": "prüfe die Größe der Überläufe für große Zähler nach dem Zusammenführen",
    "ru": "исправить таблицу станций и ускорить чтение файла после слияния",
    "pl": "sprawdź główną pętlę jeśli się śpieszy również później łańcucha",
    "es": "añade el caudal máximo mañana también según la estación pequeña",
    "en": "keep naïve café at 5 °C and show ° next to ü or é in the résumé",
    "zh": "更新降雨数据读取 检查流域列表 删除降雨数据读取",
}
SWAPS = [("fr", "cp1252", "utf-8"), ("de", "cp1252", "utf-8"), ("ru", "cp1251", "utf-8"), ("ru", "koi8-r", "cp1251"), ("ru", "cp1252", "cp1251"), ("pl", "cp1250", "utf-8"), ("es", "mac-roman", "utf-8"), ("zh", "cp1252", "gbk"), ("es", "koi8-r", "utf-8")]


def swapped(text, r, t):
    out = ""
    for b in text.encode(t):
        try:
            out += bytes([b]).decode(r)
        except UnicodeDecodeError:
            out += chr(b)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows, k = [], 0
    for n in range(60):
        for lang, line in RIGHT.items():
            words = line.split(" ")
            rows.append((k, f"Change {n}\n{' '.join(words[n % 3:])}\nend", "Repo_A " if n % 2 else "repo_a"))
            k += 1
    bad = {}
    for lang, r, t in SWAPS:
        bad[k] = f"start\n  {RIGHT[lang]}"
        rows.append((k, f"start\n  {swapped(RIGHT[lang], r, t)}", "repo_a"))
        k += 1
    bad[k] = "naïve café"
    rows.append((k, swapped(swapped("naïve café", "cp1252", "utf-8"), "cp1252", "utf-8"), "repo_a"))
    bad[k + 1] = None
    rows.append((k + 1, "fa�ade", None))
    fine = ["unit test for Ã± in café and größe", "The page printed Ã© where ° or ü belongs, now right.", "", None, "   ", "plain\r\nASCII " * 3000, "🌧️ 𝒙 ½ — “ok”"]
    rows += [(k + 2 + i, t, None) for i, t in enumerate(fine)]
    rows += [(None, "cafÃ© demo", "repo_a"), rows[-len(fine) - 3], rows[-len(fine) - 3]]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").selectExpr("*", "1 AS form", "'x' AS swap", "2 AS doc", "3 AS n"), bad


@pytest.fixture(scope="module")
def found(docs):
    return find_garbled(docs[0])


def test_finds_exactly_the_swapped(docs, found):
    _, bad = docs
    got = {r.doc for r in found.lines.filter("doc IS NOT NULL").collect()}
    assert got == set(bad)


def test_restores(docs, found):
    df, bad = docs
    got = {r.doc_id: (r.text, r.exact) for r in restore(df, found=found).collect()}
    assert set(got) == set(bad)
    right = {k for k, t in bad.items() if t is not None and got[k] == (t, True)}
    assert len(right) >= len(bad) - 2  # the lost character, and at most one more
    assert got[max(bad)] == ("fa�ade", False)


def test_keys_are_per_source(found):
    keys = {(r.unit, r.letter) for r in found.keys.filter("swap = 'cp1252>utf-8' AND source = 'repo_a'").collect()}
    assert ("Ã©", "é") in keys and ("Ã¼", "ü") in keys


def test_units():
    assert units("cafÃ©", "cp1252>utf-8") == (["c", "a", "f", "Ã©"], ["c", "a", "f", "é"]) and units("café", "cp1252>utf-8") is None
    assert units("Ñ�Ð°", "cp1252>utf-8") == (["Ñ�", "Ð°"], [None, "а"])
    assert units("cafÃƒÂ©", "cp1252>utf-8>cp1252>utf-8") == (["c", "a", "f", "ÃƒÂ©"], ["c", "a", "f", "é"])
    assert units("aÐ°Ð±", "?2:CYRILLIC") == (["a", "Ð°", "Ð±"], ["a", None, None]) and units("é", "?2:LATIN") is None


UNLISTED = {
    "cp1257": "vanduo žemė upė ąžuolas čia šaltinis žiema šalta diena miško takas žvejys plaukė ežeras gražus žalia žolė šiltas vėjas pūtė nuo jūros "
    "krantų gyveno žmogus kuris mėgo žuvį ir šviesą žvaigždė švietė virš upės vaikai žaidė šalia kelio močiutė kepė šviežią duoną tėvas taisė tinklą",
    "cp1255": "המים זורמים בנהר אל הים הגדול והרוח נושבת מעל ההרים הגבוהים ילדים משחקים ליד הבית הישן אבא תיקן את הרשת אמא אפתה לחם טרי בבוקר "
    "הדג שוחה במים הקרים והכוכב האיר את השמים בלילה האיש אהב את האור ואת הדרך הארוכה אל הכפר השקט שליד העמק הירוק",
    "tis-620": "น้ำไหลลงสู่ทะเลใหญ่ ลมพัดผ่านภูเขาสูง เด็กเล่นอยู่ใกล้บ้านเก่า พ่อซ่อมตาข่าย แม่อบขนมปังสดในตอนเช้า ปลาว่ายในน้ำเย็น ดาวส่องแสงในท้องฟ้ายามค่ำคืน "
    "ชายคนนั้นรักแสงสว่าง และถนนยาวไปยังหมู่บ้านที่เงียบสงบ ใกล้หุบเขาสีเขียว ฝนตกหนักเมื่อวานนี้ ชาวนาปลูกข้าวในนา",
}


def test_keys_from_nothing(spark):
    """Pages that are in no list: their languages are known from other sources, their keys are not."""
    rng, rows, bad, k = random.Random(5), [], set(), 0
    for n in range(900):
        for page, text in UNLISTED.items():
            words = text.split(" ")
            line = " ".join(rng.choice(words) for _ in range(8))
            right = n % 6 != 0
            rows.append((k, f"note\n{line if right else swapped(line, 'cp1252', page)}", f"right{n % 3}" if right else f"old_{page}"))
            bad |= set() if right else {k}
            k += 1
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    text = {i: t for i, t, _ in rows}
    got = {r.doc_id: r.text for r in restore(df).collect()}
    assert set(got) <= bad
    by = {p: [i for i in bad if rows[i][2] == f"old_{p}"] for p in UNLISTED}
    found = {p: sum(i in got for i in ids) / len(ids) for p, ids in by.items()}
    assert min(found.values()) >= 0.95, found
    # letters read back, by place; both texts have as many characters
    for p, ids in by.items():
        pairs = [(x, y) for i in ids if i in got for x, y in zip(got[i], _unswapped(text[i], p)) if not y.isascii()]
        assert sum(x == y for x, y in pairs) / len(pairs) >= 0.8, p


def _unswapped(text, page):
    return b"".join(c.encode("cp1252") if c in "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ" else bytes([ord(c)]) for c in text).decode(page)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, source string")
    assert garbled_ids(df).collect() == [] and restore(df).collect() == []
