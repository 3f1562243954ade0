"""Labelled sentences for the segment model, written from a small grammar of our own.

No labelled rows come with the data, so the model is trained here: carrier phrases in four languages with slots, filled from
seeded generators of e-mail addresses, phone numbers, identity numbers, addresses and names, and with look-alikes (amounts, times,
receipt and reference numbers, versions, handles, roles, places) that are no personal information.
"""

from __future__ import annotations

import random

TYPES = ("email", "phone", "id_number", "address", "name")

_CARRIERS = {
    "email": ["email saya {}", "kirim ke {} ya", "balas ke {}.", "surel: {}", "my address is {}, thanks", "write me at {} please", "mail {} today", "contact {}", "escribe a {} por favor", "mi correo es {}", "mon courriel {} merci", "répondez à {}", "{}", "by {}", "bukti dari {} tadi"],
    "phone": ["wa saya {}", "whatsapp saya {}, terima kasih", "sms ke {}", "tlp {}, tolong", "nomor saya {}", "call {} tonight", "ring {} 2 times", "hubungi {} 3 kali", "hp {} 24 jam", "appelez le {} 2 fois", "hubungi {} ya", "wa {}", "telepon saya di {}", "nomor hp {} aktif", "no. telp {}", "nomor terdaftar {} tidak dapat kode", "call me on {}", "phone {}", "my number is {} thanks", "text {} after six", "registered number {}", "llame al {}", "mi teléfono {} gracias", "el número {}", "appelez le {}", "mon numéro {} merci", "joindre au {}", "{}"],
    "id_number": ["nik {} 2 kali ditolak", "passport or id {} please", "nik {} ditolak", "ktp saya {}", "ktp {} diunggah", "KTP {}", "nomor identitas {}", "npwp {} tidak valid", "no identitas {} salah", "my id {} was refused", "ssn {}", "social security {}", "id no. {} uploaded", "tax number {}", "mi dni {}", "documento {} erróneo", "nie {}", "numéro de sécurité sociale {}", "ma carte {} refusée", "social number {} wrong"],
    "address": ["alamat saya {}", "tinggal di {}", "warung di {} dekat masjid", "survei ke {} besok", "kirim ke {}", "i live at {}", "the shop is at {} near the bakery", "send it to {} tomorrow", "vivo en {}", "la tienda está en {}", "j'habite au {}", "la boutique est au {} près du parc"],
    "name": ["my name is {}", "nama saya {}", "reporter: {}", "dr. {} called", "mr {} called back", "me llamo {} y", "je m'appelle {}", "madame {} attend", "jurnalis {}", "señora {} espera", "penulis: {}", "laporan {}", "oleh {}", "rekening atas nama {} diblokir", "pak {} datang", "bu {} sabar", "menurut {}, pemilik", "saya {}, mitra", "by {}", "i am {}, a partner", "the account of {} is blocked", "according to {}, who runs it", "mrs {} helped", "texte de {}", "par {}", "au nom de {} reste", "selon {}, gérante", "según {}, encargada", "a nombre de {} sigue", "{}", "(pasar/{})", "{} (kontributor)", "{} (agen)"],
}

_NEGATIVES = [
    "order {card}", "order number {card} is late", "nomor pesanan 08{long}", "no. pesanan {long}", "pesanan 08{long} dikirim", "pedido {long} en camino", "commande {long} en retard", "invoice {card}", "resi {long}", "tracking 08{long}", "my name is not on it", "nama saya salah", "reporter datang lagi", "dr. {last} called", "mr {last} left", "look at the dot on it", "about {small} of them stood in st", "{small} percent rise in rd", "di titik itu saja",
    "potongan Rp {amt} nambah", "saldo Rp{amt} raib", "sebesar {amt} ribu", "a fee of ${amt} again", "{amt} dollars left", "por {amt} euros", "{amt} € de plus", "nomor referensi {long} sudah disimpan", "reference number {long} is pending", "kode struk TRX{long} tidak ada",
    "receipt code TRX{long} was not found", "kode mesin {long} dilaporkan", "la référence {long} reste", "la referencia {long} sigue", "order {long}", "versi {small}.{small}.{small} sama saja", "version {small}.{small} is slow", "pukul {h}.{m}", "at {h}:{m} today", "tiket {long} ditutup", "ticket no. {long}",
    "di {place} antrean {small} orang", "sekitar {small} warga {place}", "about {small} villagers near {place}", "à {place} le guichet numéro {small}", "en {place} el punto número {small}", "kepala dusun di {place} melapor", "pasar {place} buka", "kantor {place} menerima", "gerai nomor {small}", "outlet number {small} closed", "the {place} office reported",
    "user_{place}{small}", "agen.{place}{small}", "@warung_{place}", "redaksi", "newsroom", "admin", "[deleted]", "lapor {place} lestari", "on {place} road rain closed it", "jalan ke {place} ditutup hujan", "menutup jalan ke {place}", "closed the road to {place}", "la route de {place} coupée", "el camino a {place}",
    "{first} bilang begitu", "kata {first} tadi", "toko {last} buka", "{first} lagi", "kios {last} {place}", "kepada {first} di {place}", "mrs {last} helped", "pak {first} datang", "{place}, {place}", "Warta {Place} hari ini", "Harian {Place}", "Tim {Place} melapor", "Kabar {Place}", "Laporan {Place} hari ini", "According to {Place} office", "By {Place} today",
    "pak rt datang", "kang {place}", "{year}-{m}-{h}", "{h}/{m}/{year} sudah", "build {small}{small}", "dikirim dari aplikasi versi {small}{small}", "{long} pembaca", "copyright {year} {place}", "hak cipta {year} warta {place}", "street market {place} opens", "{amt} although rain closed the road to {place}", "until {h}:{m} although rain closed the road", "{small} people on the other road", "{small} shops along the long avenue", "jalan ke {place} {small} hari ditutup",
    "kepala dusun di {place} menyiapkan {small} mesin", "dusun di {place} menolak pungutan {amt} ribu", "gang di {place} selebar {small} meter",
    "terjemahan otomatis oleh {Site}", "Diterjemahkan oleh {Site}", "redaksi {Site}", "kerja sama {Site}", "by the {Site} desk", "jalan terus {small} hari", "gang sebelah ribut",
]

_FIRST = "ratna budiono surya marlina agustina wahyono petrus kirana dewanto sulastri emmet harriet clement rosalind bernice walter ines joaquin lucrecia etienne margaux colette".split()
_LAST = "hadikusuma wirasena prabantara situmpul panggalo lestaluhu winterbourne hathersage ashdown penrose castellar valdemora montclair beaufremont delacourt".split()
_DOMAINS = ["surat.example", "mail.test", "kotak-pos.example", "correo.example", "toko.co.invalid"]
_STREETS = ["Melati Raya", "Sawo Dua", "Anggrek", "Rambai Tua", "Garuda Lama"]
_EN_STREETS = ["Maple", "Old Tannery", "Miller's Gate", "Harbour", "Elm"]
_PLACES = "Sukamakmur Tirtosari Brackley Ashford Villarejo Montbrun Karangsono Wonorejo Saint-Aubin San Lucas".split()


class _Maker:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def digits(self, n: int) -> str:
        return "".join(self.r.choice("0123456789") for _ in range(n))

    def group(self, text: str, sizes: list[int], sep: str) -> str:
        out, at = [], 0
        for s in sizes:
            out.append(text[at : at + s])
            at += s
        return sep.join(x for x in [*out, text[at:]] if x)

    def email(self) -> str:
        a, b = self.r.choice(_FIRST), self.r.choice(_LAST)
        local = self.r.choice([f"{a}.{b}", f"{a}{self.r.randint(1, 99)}", f"{b}_{a}", f"{a}+kios", f"toko.{a}", f"{a[0]}{b}"])
        d = self.r.choice(_DOMAINS)
        kind = self.r.random()
        if kind < 0.05:
            return f"{a} dot {b} at {d.split('.')[0]} dot {self.r.choice(['com', 'org', 'test', 'example'])}"
        if kind < 0.12:
            return f"{local} [at] {d}"
        if kind < 0.24:
            return f"{local}(at){d.replace('.', ' dot ')}"
        s = f"{local}@{d}"
        return s.upper() if kind > 0.92 else (f"<{s}>" if kind > 0.86 else s)

    def phone(self) -> str:
        r = self.r
        tail = self.digits(r.choice([7, 8, 9]))
        sep = r.choice(["", " ", "-", "."])
        return r.choice([
            "08" + self.group("4" + tail, [2, 4], sep), f"+62 8{self.group('4' + tail, [2, 4], r.choice([' ', '-']))}", f"(+62) 8{self.group('4' + tail, [2, 4], ' ')}", "628" + "4" + tail,
            f"(0{r.choice(['21', '274', '299', '31', '499'])}) {self.digits(r.choice([6, 7]))}", f"{self.digits(3)}{r.choice('-. ')}555{r.choice('-. ')}01{self.digits(2)}", f"555-01{self.digits(2)}", f"+1 {self.digits(3)} 555 01{self.digits(2)}", f"1{self.digits(3)}55501{self.digits(2)}",
            f"+34 {self.group('5' + self.digits(8), [3, 3], ' ')}", self.group("5" + self.digits(8), r.choice([[3, 3], [3, 2, 2]]), r.choice(["", " ", "-"])), f"+33 1 {self.group(self.digits(8), [2, 2, 2], ' ')}", self.group("01" + self.digits(8), [2, 2, 2, 2], r.choice(["", " ", "."])),
        ])

    def id_number(self) -> str:
        r, letter = self.r, self.r.choice("ABCDEFGHJKLMNPQRSTVWXYZ")
        sixteen, fifteen = self.digits(16), self.digits(15)
        return r.choice([
            sixteen, self.group(sixteen, [4, 4, 4], " "), self.group(sixteen, [6, 6], "."), f"{fifteen[:2]}.{fifteen[2:5]}.{fifteen[5:8]}.{fifteen[8]}-{fifteen[9:12]}.{fifteen[12:]}", self.group(self.digits(9), [3, 2], r.choice(["-", " ", ""])),
            self.digits(8) + letter, f"{self.group(self.digits(8), [2, 3], '.')}-{letter}", f"{r.choice('XYZ')}{self.digits(7)}{letter}", r.choice("12") + self.digits(14), f"{r.choice('12')} {self.group(self.digits(14), [2, 2, 2, 3, 3], ' ')}",
        ])

    def address(self) -> str:
        r, n = self.r, self.r.randint(1, 199)
        s, e, u = r.choice(_STREETS), r.choice(_EN_STREETS), r.randint(1, 9)
        street = r.choice(["Street", "Lane", "Road", "Avenue", "Rd", "Ave", "St", "Drive"])
        text = r.choice([
            f"Jl. {s} No. {n}", f"Jl. {s} Kav. {n}", f"Jl {s} Kavling {n}", f"Jl. {s} Blok {r.choice('ABCDE')}{u} no.{n}", f"Jalan {s} Nomor {n}, RT 0{u}/RW 0{u}", f"Jl {s} No. {n} RT 0{u} RW 0{u}", f"Dusun {r.choice(_PLACES)} RT {u} RW {u} No. {n}", f"Gang {s} No. {n}", f"Kampung {s} RT 0{u}/0{u}", f"jln. {s} no {n}", f"Jl {s} no {n} {r.choice(_PLACES)}",
            f"{n} {e} {street}", f"Flat {u}, {n} {e} {street}", f"{n}{r.choice('ABC')} {e} {street}", f"{n} {e} {street}, {r.choice(_PLACES)}", f"calle del {e} {n}, {u}º C", f"calle {s} {n}", f"avenida {s} {n}", f"avenida del {e} núm. {n}", f"C/ {s}, {n}", f"C/ del {e}, {n}",
            f"{n} rue des {s}", f"{n} rue du {s}", f"{n} rue de la {e}", f"{n} avenue de la {e}", f"{n} bis, rue des {s}", f"{n} bis, avenue {e}", f"{n}, boulevard {s}",
        ])
        return text.lower() if r.random() < 0.18 else text

    def name(self) -> str:
        a, b = self.r.choice(_FIRST).title(), self.r.choice(_LAST).title()
        kind = self.r.random()
        if 0.5 < kind < 0.56:
            return f"{a} {self.r.choice(['van der', 'de la', 'bin', 'von', 'del'])} {b}"
        if 0.56 <= kind < 0.6:
            return f"{a} {self.r.choice(_FIRST).title()} {b}"
        s = f"{b}, {a}" if kind < 0.12 else (f"{b} {a}" if kind < 0.16 else f"{a} {b}")
        return s.upper() if kind > 0.86 else (s.lower() if 0.8 < kind <= 0.86 else s)


def sentences(seed: int = 11, per_type: int = 700, negatives: int = 1600) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, [(start, end, type)]) in a fixed order for a seed."""
    m = _Maker(seed)
    out: list[tuple[str, list[tuple[int, int, str]]]] = []
    for kind in TYPES:
        for _ in range(per_type):
            before, after = m.r.choice(_CARRIERS[kind]).split("{}")
            value = getattr(m, kind)()
            lead = m.r.choice(["", "", "Tadi ", "Please, ", "» ", "*"])
            start = len(lead) + len(before)
            inner = (1, -1) if value.startswith("<") else (0, 0)
            out.append((lead + before + value + after, [(start + inner[0], start + len(value) + inner[1], kind)]))
    for _ in range(negatives):
        r = m.r
        fill = {"amt": r.choice([f"{r.randint(1, 999)}", f"{r.randint(1, 9)}.{m.digits(3)}.{m.digits(3)}", f"{r.randint(1, 99)}.500", f"{r.randint(1, 9)},{m.digits(3)}.{m.digits(2)}"]), "long": m.digits(r.choice([8, 10, 12, 14, 16, 17, 18])), "card": m.group(m.digits(16), [4, 4, 4], " "), "small": str(r.randint(1, 99)), "h": str(r.randint(0, 23)), "m": f"{r.randint(0, 59):02d}", "place": r.choice(_PLACES), "year": str(r.randint(2019, 2026)), "first": r.choice(_FIRST).title(), "last": r.choice(_LAST).title(), "Place": r.choice(_PLACES), "Site": r.choice(["Forum Kios", "Kanal Usaha Jaya", "Suara Desa", "Market Gazette", "Diario Abierto"])}
        text = r.choice(_NEGATIVES)
        for k, v in fill.items():
            text = text.replace("{" + k + "}", v)
        out.append((text, []))
    m.r.shuffle(out)
    return out
