"""Fixed values about Japanese writing that several operators share."""

from __future__ import annotations

#: Old and variant forms, pairwise: every even character is written as the one after it today.
OLD_FORMS = (
    "會会總総務務觀観國国廣広學学經経濟済產産發発豫予對対縣県勞労區区醫医廳庁當当擧挙檢検實実關関應応營営"
    "聽聴變変數数體体團団圖図濱浜邊辺邉辺澤沢齋斎齊斉髙高﨑崎嵜崎櫻桜惠恵眞真嶋島嶌島籠籠槗橋桥橋瀨瀬祿禄"
    "德徳曉暁榮栄條条櫂櫂淺浅瀧滝龍竜禮礼穗穂絲糸綠緑繩縄藏蔵藝芸輕軽鄕郷鐵鉄靜静黑黒彌弥渊淵凜凛薗園塚塚"
    "槇槙曻昇舘館劍剣壽寿萬万與与靑青驛駅戶戸步歩歲歳渚渚爲為狀状獸獣畫画盡尽礦鉱稅税竝並粹粋續続"
    "聲声肅粛臺台舊旧莊荘處処號号裝装覺覚讀読讓譲賣売轉転遞逓遲遅邦邦錄録鎭鎮險険隨随雜雑靈霊顯顕飮飲驗験"
)
#: 燈 and 灯 are kept out: both are used in names, read differently.
OLD = "".join(a for a, b in zip(OLD_FORMS[::2], OLD_FORMS[1::2], strict=True) if a != b)
NEW = "".join(b for a, b in zip(OLD_FORMS[::2], OLD_FORMS[1::2], strict=True) if a != b)
MODERN = str.maketrans(OLD, NEW)

#: Katakana to hiragana.
HIRAGANA = {c: c - 0x60 for c in range(0x30A1, 0x30F7)}
