"""Optional tables of language: how kanji are read in compounds and at the end of given names, and English words for Japanese ones.

They help where a value is typed in kana or in English, or a name with another letter of the same sound. They are parameters of
`canonical.map_values` and `names.link`; without them such values are unmatched, and everything else works alike. They hold general
vocabulary, not entries of any list."""

from __future__ import annotations

#: Sino-Japanese readings of kanji as they occur in compounds. Fixed values.
READINGS = dict(
    pair.split(":")
    for pair in (
        "安:あん 医:い 委:い 育:いく 員:いん 院:いん 運:うん 営:えい 衛:えい 液:えき 化:か 介:かい 会:かい 改:かい 海:かい 械:かい 画:かく 革:かく 学:がく 活:かつ 官:かん 幹:かん 監:かん 管:かん 環:かん 観:かん 企:き 機:き 危:き 技:ぎ "
        "議:ぎ 客:きゃく 救:きゅう 給:きゅう 居:きょ 拠:きょ 漁:ぎょ 共:きょう 協:きょう 教:きょう 境:きょう 業:ぎょう 局:きょく 近:きん 金:きん 区:く 空:くう 軍:ぐん 郡:ぐん 係:けい 計:けい 経:けい 警:けい 芸:げい 決:けつ 健:けん "
        "建:けん 検:けん 県:けん 研:けん 権:けん 減:げん 源:げん 古:こ 口:こう 公:こう 交:こう 光:こう 港:こう 広:こう 康:こう 校:こう 工:こう 高:こう 行:こう 国:こく 災:さい 再:さい 最:さい 済:さい 際:さい 財:ざい 材:ざい 作:さく "
        "策:さく 察:さつ 査:さ 算:さん 参:さん 産:さん 山:さん 支:し 司:し 市:し 祉:し 施:し 資:し 事:じ 治:じ 自:じ 室:しつ 者:しゃ 社:しゃ 主:しゅ 収:しゅう 住:じゅう 獣:じゅう 述:じゅつ 術:じゅつ 書:しょ 女:じょ 助:じょ "
        "商:しょう 消:しょう 少:しょう 証:しょう 振:しん 審:しん 進:しん 人:じん 水:すい 推:すい 税:ぜい 生:せい 政:せい 整:せい 制:せい 設:せつ 選:せん 全:ぜん 組:そ 総:そう 促:そく 対:たい 体:たい 宅:たく 団:だん 男:だん 知:ち "
        "地:ち 築:ちく 長:ちょう 庁:ちょう 鳥:ちょう 聴:ちょう 町:ちょう 調:ちょう 通:つう 定:てい 鉄:てつ 点:てん 都:と 土:ど 島:とう 統:とう 同:どう 道:どう 働:どう 導:どう 特:とく 内:ない 能:のう 農:のう 納:のう 派:は 被:ひ 秘:ひ 備:び "
        "病:びょう 部:ぶ 副:ふく 福:ふく 物:ぶつ 分:ぶん 文:ぶん 別:べつ 編:へん 保:ほ 報:ほう 法:ほう 方:ほう 防:ぼう 本:ほん 民:みん 務:む 輸:ゆ 予:よ 用:よう 洋:よう 利:り 理:り 離:り 流:りゅう 療:りょう 林:りん 労:ろう 路:ろ 課:か "
        "害:がい 可:か 河:か 川:せん 厚:こう 考:こう 興:こう 挙:きょ 域:いき 移:い 湾:わん 援:えん 情:じょう 子:こ 家:か 代:だい 助:じょ 年:ねん 村:そん 連:れん 令:れい"
    ).split()
)
#: Other readings of these kanji. Fixed values.
OTHER_READINGS = {"人": "にん", "子": "し", "省": "しょう", "出": "しゅつ", "代": "たい", "家": "け", "地": "じ"}
#: Letters with which given names end and that are read alike there. Fixed values.
ENDINGS = ("乃野之", "斗都登", "人仁", "美実未", "也哉弥矢", "太多汰", "郎朗浪", "央夫雄男", "香花佳加華", "馬真麻磨", "穂帆歩", "希紀樹季貴輝", "江恵絵枝", "助介輔", "里理利莉", "奈那菜", "子己", "彦比")

#: English words of public offices and committees, with the Japanese words they stand for. Fixed values.
ENGLISH = {
    word: ja.split()
    for word, ja in (
        pair.split("=")
        for pair in (
            "chair=議長 委員長 長;chairman=議長 委員長;chairperson=議長 委員長;speaker=議長;president=議長 会長;assembly=議会 議長;vice=副;deputy=副;committee=委員会;cttee=委員会;member=委員 議員;commissioner=委員;councillor=議員;governor=知事;"
            "education=教育 文教;police=警察;headquarters=本部;general=総務;affairs=総務;department=部;director=部長 局長;section=課;division=課;manager=課長;bureau=局;planning=企画;finance=財政;fiscal=財政;personnel=人事;health=健康 厚生 保健;welfare=福祉;"
            "medical=医療;policy=政策;agriculture=農林 農政 農業;agricultural=農林 農政;forestry=農林 林務 森林;fisheries=水産;land=県土;infrastructure=県土 整備;development=整備 開発;road=道路;roads=道路;river=河川;rivers=河川;port=港湾;harbour=港湾;"
            "commerce=商工;commercial=商工;labour=労働;labor=労働;tourism=観光;environment=環境;environmental=環境;crisis=危機;emergency=危機;management=管理;accounting=会計;treasurer=会計;audit=監査;auditor=監査;election=選挙;safety=公安 安全;"
            "secretariat=事務;office=事務;witness=参考;secretary=秘書;relations=広報;tax=税務;taxation=税務;housing=住宅;culture=文化;cultural=文化;promotion=振興 推進 促進;sports=スポーツ;international=国際;information=情報;enterprise=企業;enterprises=企業;"
            "hospital=病院;hospitals=病院;childcare=子育;childrearing=子育;child=子育;support=支援;life=生活;living=生活;construction=建設;steering=運営;regional=地域;community=地域;exchange=交流;transport=交通;transportation=交通;nursing=介護;care=介護;"
            "hearing=広聴 公述;public=公共 公営;industrial=産業;industry=産業;workforce=人材;special=特別;budget=予算;accounts=決算;settlement=決算;reform=改革;population=人口;decline=減少;measures=対策;countermeasures=対策;disaster=災害 防災;water=水源 水道;"
            "conservation=保全;island=離島;islands=離島;airport=空港;utilization=利活用 活用;marine=海洋;ocean=海洋;resources=資源;wildlife=鳥獣;damage=被害;facilities=施設;reorganization=再編;gender=男女;participation=参画;migration=移住;settling=定住;base=拠点;"
            "local=地方;decentralization=分権;renewable=再生;justice=司法;fire=消防;science=科学;technology=技術;school=学校;university=大学;city=市;town=町;village=村;company=会社;bank=銀行;association=協会;centre=センター;center=センター;foundation=財団"
        ).split(";")
    )
}
