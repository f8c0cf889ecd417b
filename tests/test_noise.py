from pyspark.sql import functions as F

from millrace.functions import noise

KINDS = {
    "placeholder": ({"Konum yok", "  - SEÇİNİZ".replace("İ", "i"), "Tümü", "belirtilmemiş."}, {"Konum yok mu", "Can Motor", "", None}),
    "call_to_action": ({"Satış danışmanı ile görüşmek istiyorum", "Yol Tarifi Al", "WhatsApp hattı"}, {"Can Motor", "", None}),
    "button": ({"Ara", " detay: ", "harita"}, {"Aral", "Detay sayfası", "", None}),
    "trade_word": ({"Can Motor", "Ova A.Ş", "Gül Tic.", "show  room"}, {"Seyhan", "Motorsuz", "", None}),
    "category_list": ({"Benzinli Araç Servisi / Elektrikli Araç Servisi", "Satış Bayisi/Servis Noktası/x servis"}, {"Çakmak Motor / Şaban Çakmak", "Servis", "Servis / a / b / c", "", None}),
    "name_like": ({"Can Motor", "Işık", "abcd1234 x"}, {"243", "24d", "a1b2c3", "x@y.com", "www.ornek.com", "12 ab", "abc", "", None}),
}


def test_noise_predicates(spark):
    for name, (yes, no) in KINDS.items():
        rows = spark.createDataFrame([(x, True) for x in yes] + [(x, False) for x in no], "t string, want boolean")
        wrong = rows.filter(getattr(noise, name)(F.col("t")) != F.col("want")).collect()
        assert not wrong, (name, wrong)


def test_names_of_a_card(spark):
    parts = ["Can Motor", "Yol tarifi", "24d", "Telefon:", "Satış Bayisi / Servis Noktası", "Konum yok", "Ova Moto"]
    rows = spark.createDataFrame([(p,) for p in parts], "t string")
    assert [r["t"] for r in rows.filter(noise.may_be_name(F.col("t"))).collect()] == ["Can Motor", "Ova Moto"]
