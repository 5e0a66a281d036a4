"""The small labelled table that the tagger of personal information is trained on.

Carrier sentences hold slots; each is filled by rule several times, so spans are known. Half of the carriers are general
ones, the others a sample of the corpus labelled by hand; no name, street or mail host is taken from it. P person, E e-mail, T phone,
I identity number, A address; lower-case slots (w noun, c place, n number and so on) are ordinary text. All values are invented.
"""

from __future__ import annotations

import random
import re

# Carriers with mentions, by script of their slots. They are about everyday matters, not about any table in use.
CARRIERS = {
    "ja": """昨日、{P}さんから手紙が届いた。|{P}さん（{n}）は店を始めて{n}年になる。|隣の{P}さんは犬を飼っている。|{P}さんによると、雪は明け方に止んだ。|「また来ます」と{P}さんは笑った。|長男の{P}さんが跡を継いだ。|店主の{P}さん（{n}）が{w}を案内した。|被害に遭った{P}さんは「驚いた」と話す。|監督は{P}氏が務める。|社長の{P}氏は退任する。
{P}氏、{P}氏が候補に挙がった。|新しい役員に{P}氏と{P}氏を選んだ。|{P}、{P}の両選手が出場する。|代表に{P}、副代表に{P}の各氏が選ばれた。|出席者は{P}氏、{P}氏、{P}氏。|{P}先生の授業は{n}時に始まる。|担任の{P}先生に相談した。|医師の{P}先生が診察する。|{P}様　このたびはありがとうございました。|{P}様宛ての荷物を預かっています。
宛先：{A}　{P}様|お届け先は{A}、{P}様。|{A}　{P}様方|差出人は{P}（{A}）。|請求書は{A}へ送ってください。|本社は{A}に移った。|住まいは{A}です。|引っ越し先は{A}だという。|店は{A}、駅から徒歩{n}分。|所在地　{A}|郵送先：{A}　{w}係|{P}さんは{A}に移り住んだ。|{A}の{P}さん（{n}）方から出火した。|現場は{A}の空き地。
予約は{P}（電話{T}）まで。|予約は電話{T}へ。|電話番号は{T}です。|{T}までお電話ください。|TEL {T}|Tel：{T} FAX：{T}|ファクス{T}でも受け付ける。|携帯は{T}。|緊急の連絡先は{T}（{P}）。|担当{P}　{T}|受付は{P}、電話{T}。|夜間は{T}に{P}が出る。|{P}の携帯{T}にかけたがつながらない。
メールは{E}へ。|{E}まで申し込む。|申込先：{E}|{P}さん（{E}）に尋ねてください。|質問は{P}（{E}）へ。|連絡は{E}か電話{T}で。|E-mail：{E}／電話：{T}|アドレスは{E}に変わった。
{ij}を用紙に書く。|控えに{ij}が残っていた。|{P}さんの{ij}が漏れた。|{P}氏の{ij}を誤って送った。|{ij}、氏名{P}と記入した。|{ij}を控えた。署名は{P}だった。|{P}が{ij}を提示した。|窓口で{ij}を確かめる。
会計は{P}が受け持つ。|作者は{P}。|撮影は{P}、文は{P}。|司会の{P}が開会を告げた。|講師は{P}さん。|{P}会長が挨拶した。|{P}館長は来月で退く。|{P}社長に聞いた。|{P}教授は結果を慎重に見ている。|{P}学芸員の説明を聞いた。|記者の{P}です。|{P}は{w}を始めた。|{P}が{w}の代表に就いた。|署名欄に{P}とある。""",
    "zh": """昨天{P}来信说一切都好。|{P}先生在门口等候。|{P}女士今年{n}岁。|请找{P}，电话{T}。|联系人：{P}　电话：{T}|联系人{P}，手机{T}。|负责人{P}，邮箱{E}。|有事请打{T}。|来信请寄{A}，{P}收。|地址：{A}|住址是{A}。|公司搬到{A}。|{P}住在{A}。|电子邮箱：{E}|请发送到{E}。|登记表上的{iz}是{P}的。|{iz}，姓名{P}。|署名{P}。|{P}老师讲{w}。|表上写了{iz}，签字{P}。""",
    "ko": """어제 {P} 씨가 왔다.|{P} 씨는 {n}살이다.|예약은 {P} 씨({T})에게 하세요.|담당자는 {P}, 전화 {T}.|담당 {P} ({E})|메일은 {E}로 보내 주세요.|이메일: {E}|전화 {T}|연락처는 {T}입니다.|{P} 선생님이 {w}를 가르친다.|{P} 관장은 웃었다.|{ik}, 이름 {P}.|신청서에 {ik}가 적혀 있다. 서명은 {P}.|사장 {P} 씨가 물러난다.|기자 {P}""",
    "en": """Yesterday {P} sent a letter from {c}.|My neighbour {P} keeps two dogs.|I met {P} and {P} at the station.|{P}, the baker, opens at six.|{P} said the snow would melt by noon.|"It was a long day," said {P}.|"Come back soon," {P} told the guests.|{P} asked, "Who paid for this?"|According to {P}, the road is closed.|The prize was handed over by {P}.|Signed by {P} on the last page.|Signed, {P}|Please ask for {P} at the desk.|Ask for Ms {P} when you arrive.|Mr {P} will be out until Monday.|Mrs. {P} has moved to {A}.|Dr. {P} can see you on Friday.|Dr {P} thanked the nurses.|Prof. {P} teaches at night.|Captain {P} scored twice.
Director {P} refused to answer.|Coach {P} praised the team.|Our contact is {P} ({E}).|Questions go to {P} at {E}.|Contact: {P}, {T}|Contact {E} or phone {T}.|Email: {E} / Tel: {T}|Write to {E} by Friday.|Call {P} on {T}.|Phone {T} and ask for {P}.|Call {T} after six.|The line is {T}.|{P} and {P} answer the phone ({T}).|Send the parcel to {A}.|Ship to: {P}, {A}|{P} of {A} won the raffle.|{P}, who lives at {A}, heard the noise.|The shop at {A} has closed.|Our office is at {A}.
The form shows {ie} for {P}.|Her {ie} was on the slip.|The clerk noted {ie} and the name {P}.|He wrote {ie} on the back.|A copy with {ie}, signed by {P}, was lost.|Thanks to {P} for the photos.|{P} is {n} years old.|{P} has led the {w} since spring.|Editor: {P}|Photo: {P}|By {P}""",
    "de": """Gestern schrieb {P} aus {c}.|Unser Nachbar {P} hat zwei Hunde.|„Das war knapp“, sagte {P}.|„Kommt bald wieder. Wir warten.“, rief {P}.|Frau {P} ist bis Montag verreist.|Herr {P} kommt um acht.|Frau {P} zog {A} ein.|Herr {P} wohnt jetzt {A}.|Dr. {P} hat am Freitag Zeit.|Prof. Dr. {P} lehrt abends.|Fragen an {P}: {E}|Kontakt: {P}, Tel. {T}|Rückfragen beantwortet {P} unter {T}.|Telefon: {T}|E-Mail: {E}|Anmeldung bei {P} ({E})|Auf dem Zettel stand die {id}, unterschrieben von {P}.|Die {id} gehört {P}.|{P} bedankte sich bei allen.|{P} leitet {w} seit Mai.|Laut {P} bleibt die Straße zu.|Lieferung an {A}.|Trainer {P} lobte die Mannschaft.""",
    "fr": """Hier {P} a écrit de {c}.|Notre voisin {P} a deux chiens.|« Revenez vite », a dit {P}.|« C'était long. On rentre. », a soufflé {P}.|Mme {P} est absente jusqu'à lundi.|M. {P} arrive à huit heures.|Mme {P} vit {A}.|M. {P} loge au {A}.|Le Dr {P} reçoit le vendredi.|Contact : {P}, {T}|Contact : {E}|Écrire à {P} ({E}).|Tél. : {T}|Réservations au {T}.|Courriel : {E}|Le reçu porte le {if} de {P}.|Sur la fiche, le {if}, signé {P}.|Signé {P}.|Selon {P}, la route est fermée.|{P} remercie les voisins.|{P} dirige {w} depuis mai.|Livraison : {A}.|L'entraîneur {P} a salué l'équipe.""",
    "hi": """कल {P} का पत्र आया।|श्री {P} सोमवार को लौटेंगे।|डॉ. {P} शुक्रवार को मिलेंगे।|{P} ने कहा कि सड़क बंद है।|“जल्दी आना।” {P} ने कहा।|फ़ोन: {T}|फ़ोन {T} पर {P} से पूछें।|ईमेल: {E}|श्रीमती {P} का घर यहीं है।""",
    "ar": """كتب {P} رسالة أمس.|قالت {P} إن الطريق مغلق.|السيد {P} غائب حتى الاثنين.|د. {P} يستقبل المرضى يوم الجمعة.|قال د. {P}: «عودوا قريبا. نحن ننتظر.»|هاتف: {T}|اتصل على {T}.|البريد: {E}|السيدة {P} تسكن هنا.""",
    "th": """เมื่อวาน คุณ {P} ส่งจดหมายมา|คุณ {P} จะกลับวันจันทร์|คุณ {P} กล่าวว่าถนนปิด|โทร {T}|โทรศัพท์ {T} ติดต่อ {P}|อีเมล {E}|ดร. {P} รับนัดวันศุกร์""",
}
# Sentences without a mention, of numbers and names that aren't personal among them.
PLAIN = {
    "ja": """雨は{n}日まで続く見込みだ。|{c}で{w}が開かれた。|{c}の{w}は{n}年続く。|{c}と{c}を結ぶ道が通れない。|第{n}回{w}を{c}で開く|{c}、{w}に{n}件|{c}の{h}が{n}年ぶりに開く|{h}（{c}）の{w}|{c}立{h}は{w}を始める。|今年の{w}は{n}.{n}％増えた。|費用は{n},{n},{n}円に上る。|法人番号{n}-{n}-{n}の会社。|管理番号{n}-{n}-{n}を棚に貼る。|整理番号{d9}をお持ちください。|受付番号は{n}-{n}。|公告第{n}-{n}-{n}号|ISBN978-4-{n}-{n}-{n}の本|券は@{n}円。|品番{n}-{n}は売り切れ。|口座は{n}支店。
{f}賞を受けた作品。|{f}記念館は休館日。|{f}基金から{n}万円。|{f}町の{w}。|{f}村では{w}が盛んだ。|{f}文庫を読む。|{f}財団が{w}を支える。|会議は{w}（{w}を除く）を認めた。|課長は{w}を見送ると述べた。|担当者は{c}で{w}を調べた。|委員会は{w}をまとめた。|委員は{w}の案を審議した。|館長は「{w}を続ける」と語った。|学芸員が{w}を選んだ。|代表は{w}を断った。|会長は{c}を訪れた。|審議会が{w}を答申した。|「{w}はいつか」と記者が尋ねた。|監督は{w}に触れなかった。
『{w}』は{c}の{w}を描く。|Ver.{n}.{n}の{w}を配る。|{w}はどうなるのか。|{w}だけでは足りない！|{w}、{w}、{w}を柱とする。|{w}と{w}を合わせて行う。|新しい{w}……まだ形は見えない。|{w}の日は{n}年{n}月{n}日。|{n}日午後{n}時から{w}。|資料No.{n}に{w}の表がある。|別表{n}（{n}KB）|{w}への応募は{n},{n}件。|{w}の人手は{n}人に減った。|{n}.{n}億円を{w}に回す。|© {n} {c}|© {n} {c}新聞社|（c）{n} {c}タイムス|内線{n}|{n}人が{w}に加わった。|{w}の由来を調べる。
{l}は{c}に伝わる。|{c}の{l}を守る。|{l}（{c}）の{w}。|{l}の{w}が途絶えた。|来月、{l}を公開する。|{l}を{w}に役立てる。|{k}が{w}を始めた。|{k}と{c}が{w}で組む。|{k}の{w}は{n}件。|{k}に{n}億円をかける。|{k}を見学した。|{k}は{w}を見直す。|{k}の運営をどうするか。|展覧会は{k}で開く。|{k}の例に{h}が倣う。|{c}総合{w}法が通った。|𠮷の字を使う。|係は{w}を{w}へつなぐ。""",
    "zh": """雨要下到{n}号。|{c}举办{w}。|第{n}届{w}在{c}开幕|{c}与{c}合办{w}。|登记号{n}-{n}|编号{n}-{n}的{w}。|增长{n}.{n}％。|《{w}》讲{c}的{w}。|{w}和{w}一起做。|什么时候开始{w}？|负责人说：“先看{w}。”|新的{w}……还没有定。|{n}人参加{w}。|附表{n}（{n}KB）|{c}把{w}交给{w}。|{c}重开{w}。|{c}公布{n}项{w}""",
    "ko": """비는 {n}일까지 온다.|{c}에서 {w}가 열린다.|제{n}회 {w} {c}에서 개막|등록번호 {n}-{n}|관리번호 {n}-{n}|예산은 {n}.{n}억 원이다.|{w}와 {w}를 같이 한다.|언제 {w}가 시작되나?|담당자는 “{w}를 보자.”라고 했다.|{c} {w} 자료 No. {n}|{n}명이 {w}에 왔다.|{c}는 {w}를 늘린다.|{c} {w} {n}년""",
    "en": """Rain is due until the {n}th.|{c} holds its {w} in May.|The {w} in {c} drew {n} people.|Meeting {n} on the {w}|{n} years of {w} in {c}|{c} backs the {w} with {n} pounds|Item no. {n}-{n}-{n} is sold out.|Lots {n}-{n} to {n}-{n} are gone.|ISBN 978-1-{n}-{n}-{n}|Order ref. {n}-{n}|Room {n}, East Wing, is shut.|Tickets @ {n} pounds.|The {g} Prize is open to all.|The {g} Foundation gave {n} pounds.|The {g} Gallery shows the {w}.|The {g} Museum in {c} has moved.|{c} Concert Hall is full.|The {c} Council met on the {w}.|St. {g}'s School won.|{g} & Co. made the {w}.|{g} & Sons sold the {w}.|Is the {w} safe?|What a {w}!|The U.K. {w} and the U.S. {w} differ.|The {w} ... all {n} of it ... arrived.
It rose {n}.{n} per cent, e.g. in {c}.|It opens at {n}.30 p.m. on Friday.|See p. {n} for the {w}.|No. {n} covers the {w} of {c}.|Reviewed in the {c} Review|By the {c} Times news desk|(c) {n} {c} Times, all rights reserved|Updated {n} minutes ago|The Director praised the {w}.|The Curator of the {w} left.|A spokesman said the {w} was late.|Work on the {w} went to a firm in {c}.|The {w} and the {w} share a roof.|Our {w} needs a new {w}.|Visit the North Gate and the Old Mill.|Winter Market opens in {c}""",
    "de": """Regen bis zum {n}. Mai.|{c} feiert {w}.|{w} in {c} zog {n} Gäste an.|{n}. Treffen in {c}|{n} Jahre {w} in {c}|Artikelnummer {n}-{n}-{n}|Inventarnummer {n}-{n}-{n}|Die {g}-Stiftung gab {n} Euro.|Der {g}-Preis ist offen.|Etwa {n},{n} Mio. Euro, z. B. für {w}.|Am {n}. Juni beginnt {w}.|Nach Abs. {n} gilt {w}.|Wann kommt {w}?|Die {n}. Auflage kostet {n}.50 Euro.|Der Rat von {c} prüft {w} und {w}.|Der Direktor lobte {w}.|Laut Sprecher fehlt {w}.|© {n} {c} Zeitung, alle Rechte vorbehalten|© {n} Verlag {c} Anzeiger|(c) {n} {c} Tagblatt|{c} baut {w} aus""",
    "fr": """Pluie jusqu'au {n} mai.|{c} fête {w}.|{w} à {c} : {n} visiteurs|{n}e rencontre à {c}|{n} ans de {w} à {c}|Référence {n}-{n}-{n}|Cote {n}-{n}-{n}|Le prix {g} est ouvert.|La fondation {g} donne {n} euros.|Il atteint {n},{n} M€ pour {w}.|L'art. {n}, cf. p. {n}, vise {w}.|Quand viendra {w} ?|Quelle foule !|La mairie de {c} étudie {w} et {w}.|Le directeur a loué {w}.|Selon la ville, {w} manque.|© {n} {c} Courrier, tous droits réservés|© {n} Le Journal de {c}|Journal {c} Matin, édition du {n} mai|(c) {n} {c} Gazette|{c} agrandit {w}""",
    "hi": """बारिश {n} तारीख तक होगी।|{c} में {w} खुला।|{w} की {n}वीं बैठक|क्रमांक {n}-{n}|{n} लोग {w} में आए।|{w} कब खुलेगा?|{c} में {w} और {w}|{n} वर्ष बाद {w}""",
    "ar": """المطر حتى يوم {n}.|{c} تفتح {w}.|اللقاء {n} في {c}|رقم {n}-{n}|حضر {n} شخصا إلى {w}.|متى تفتح {w}؟|بلغ المبلغ {n}.{n} مليون.|ناقش المجلس {w} مع {w}.|{c} وسعت {w} بعد {n} عاما""",
    "th": """ฝนตกถึงวันที่ {n}|{c} เปิด{w}|การประชุม{w}ครั้งที่ {n}|มีคนมา {n} คนที่{w}|ผู้จัดการกล่าวว่า “{w}จะเปิดใหม่”|งบ {n}.{n} ล้านบาท เพื่อ{w}|{w}และ{w}ในเมือง {c}|เลขที่ {n}-{n}""",
}
# The labelled sample of the corpus. Forms of sentences read in it and labelled by hand, their values made slots.
CORPUS_CARRIERS = {
    "ja": """会場の事務局は{A}、電話{T}。|事務局は{A}にある。|返却先：{A}　{P}様|返却先：{A}　{P}様|返却先：{A}　{P}様|送り先：{A} {P}様|返却先は{A}、{P}様宛て。|送付先：{A}　{w}係
取材に応じた{P}さん（{n}）は{A}に住む。|{P}さん（{n}）は{A}に住んでいる。|申し込みは{P}さん（{E}）まで。|申し込みは{E}へ。|問い合わせは{P}（{E}）。
{P}館長の{ij}が誤って掲載された。|{P}氏の{ij}が載った。|応募書類には{ij}と記され、{P}の署名があった。|書類の{ij}を確認した。|{ij}を{P}が届け出た。
委員に{P}、{P}の両氏が就いた。|委員は{P}氏、{P}氏、{P}氏の三人。|{P}氏の連絡先は{T}。|連絡先は{T}（{P}）。|TEL{T}（受付は{P}）|TEL：{T}|FAX {T}|電話は{T}まで。|携帯{T}に{P}が出る。
E-mail {E} ／ FAX {T}|メール：{E}|{P}先生が{w}を語った。|{P}さんは{w}を続ける。|「{w}を守る」と{P}さんは話す。|担当は{P}（電話{T}）。|住所：{A}|{P}学芸員が説明した。|{P}は{w}の代表を務める。|署名は{P}。|講師の{P}氏を招いた。""",
    "zh": """联系人{P}，电话{T}。|联系人：{P}，手机{T}|表格上写着{iz}，署名{P}。|邮箱{E}，地址{A}。|地址：{A}|电话{T}|{P}先生说{w}已经开放。|{P}女士住在{A}。|请致电{T}联系{P}。|请发邮件至{E}。""",
    "ko": """문의는 {P} 씨({T})에게.|서류에는 {ik}, 서명은 {P}.|이메일 {E}|전화 {T}|담당 {P} ({E})|{P} 씨는 {w}를 맡았다.|{P} 관장은 {w}를 소개했다.|연락처: {T}""",
    "en": """Contact: {E} / {T}|Call {T} and ask for Ms {P}.|Call {T} and ask for Mr {P}.|Curator {P} declined to comment.|Write to {P} at {E} for details.|{P}, of {A}, lent the panels.|Returns go to {A}.|Send it to {A}.
The form gave {ie} and a signature by {P}.|The file held {ie}.|Mr. {P} and {P} share the desk ({T}).|{P} and {P} share the desk ({T}).|{P} said, "We keep the {w}. Then we open the {w}." and left.|{P} asked, "Will the {w} last?"|Dr. {P} said the {w} would need {n} million more.
Mrs {P} lives at {A}.|E-mail {E}|Phone: {T}|Director {P} praised the {w}.|"The {w} is safe," said {P}.|Fax {T}|{P} wrote about the {w} of {c}.|Prof. {P} spoke on {w}.|Signed by {P}.|Ask {P} ({E}).""",
    "de": """Anmeldung: {E}|Auskunft gibt {P} unter {T}.|Frau {P} wohnt {A}.|Herr {P} wohnt {A}.|Im Formular stand die {id}, gezeichnet {P}.|Prof. Dr. {P} nannte {w} den Kern der Reform.|{P} lobte {w} usw., blieb aber bei {w} vorsichtig.|„Wir behalten {w}. Danach kommt {w}.“, sagte {P}.|Telefon {T}|Dr. {P} leitet das {w}.|Kontakt: {P}, {E}""",
    "fr": """Renseignements au {T}.|Contact : {P}, {E}.|Mme {P} habite {A}.|M. {P} habite {A}.|Le dossier portait le {if}, signé {P}.|M. {P} défend {w} contre l'avis de {c}.|Mme {P} attend {n} visiteurs, etc., pour {w}.|« Gardons {w}. Ouvrons {w}. », a lancé {P}.|Courriel : {E}|Tél. {T}|Le Dr {P} soutient {w}.""",
    "hi": """डॉ. {P} ने {w} के लिए {n} करोड़ माँगे।|“{w} बचाइए। फिर {w} खोलिए।” ऐसा {P} ने कहा।|फ़ोन {T}|ईमेल {E}|श्री {P} से {T} पर पूछें।""",
    "ar": """قال د. {P}: «نحفظ {w}. ثم نفتح {w}.» ثم غادر.|هاتف {T}|البريد {E}|السيد {P} يدير {w}.""",
    "th": """โทร {T}|อีเมล {E}|คุณ {P} กล่าวถึง {w}|ติดต่อ {P} โทร {T}""",
}
CORPUS_PLAIN = {
    "ja": """{w}の行方　{c}の{n}日間|第{n}回{c}{w}会議を開催|{c}、{w}と{w}の支援枠を{n}件に|{c}の{h}、{w}を{n}年ぶりに再開|{h}（{c}）で{w}展－{w}の{n}点|{c}{h}の{w}計画、{n}項目を公表|法人番号{n}-{n}-{n}は変更ない。|管理番号{n}-{n}-{n}の資料を公開した。|整理番号{d9}の箱が見つかった。|公告第{n}-{n}-{n}号による。
予算額は{n},{n},{n}円だった。|図録のISBNは978-0-{n}-{n}-0。|@{n}円の前売り券は完売した。|{f}賞の受賞作が決まった。|{f}記念館は{n}人を迎えた。|{f}町の{w}を調べた。|{f}文庫の{w}を公開した。|{c}議会は{w}（{w}を含む。{w}は除く。）の案を可決した。|{h}の運営をめぐり、{w}と{w}の両立が問われている。|{c}の{w}は前年度比{n}.{n}％増の見込みだ。
館長は「{w}を守りたい。次は{w}だ。」と語った。|担当課長は{c}の由来を調べ、{w}へつなげた。|学芸員によれば、{w}の要件は{w}と{w}の二つだという。|「{w}はどうなるのか？」と学芸員が問いかけた。|審議会の委員は{w}の由来を調べた。|保存会の代表は「{w}を守りたい。」と語った。|Cookieより紙の台帳だ、と担当課長は{w}の現場を語る。|{w}の日程は{n}日午後{n}.5時間に及んだ。|資料集No.{n}とVol.{n}には{w}と{w}の一覧が載る。
『{w}白書。{c}編』は{w}の記述を増やした。|Ver. {n}.{n}の指針では{w}の手順が改められた。|{w}をどう支えるのか？|{w}だけで足りるだろうか!?|{w}をめぐる検討が{c}で始まった。|{c}に伝わる{c}踊りが{w}の対象に加わった。|{c}では{w}をきっかけに{w}が広がった。|来年度は{w}の枠を{n}件に広げ、{w}を組み合わせる。|{w}への応募は{n},{n}件に達したと発表した。|{w}の担い手は{n}人に減り、{w}も細っている。|新しい{w}……それは{w}の延長にすぎないとの声もある。|著作権（Copyright）の扱いは{w}の契約書に明記される。|{h}は{w}に約{n}.{n}億円を充てると発表した。
{c}総合振興法が{c}で{w}の公募を始めると発表した。|{w}事業と{w}の担当者が{c}に集まり、{w}を議論した。|© {n} {c}新報 無断転載を禁じます|別紙{n}（PDF形式：{n}KB）|問い合わせ先　{c}管理係　内線{n}|{w}は{n}年{n}月{n}日に開く。|{c}窯（{c}）の記録が{w}に役立てられる。|{c}の{w}について、{h}は{w}の例を参考にした。|{c}{w}凧（{c}）の記録が{w}に役立てられる。|𠮷田式の棚|{w}を{w}に組み込む動きが来年度も続く。|{w}、{w}、{w}の三分野を重点とする。
{l}（{c}）の記録が{w}に役立てられる。|{c}に伝わる{l}が{w}の対象に加わった。|学芸員は{l}の由来を調べ、{w}へつなげた。|館長は{l}の由来を調べ、{w}へつなげた。|審議会の委員は{l}の由来を調べ、{w}へつなげた。|{l}（{c}）の記録が{w}に役立てられる。|{c}に伝わる{l}が{w}の対象に加わった。|{l}の継承を{c}が支える。
{k}は{w}に約{n}.{n}億円を充てると発表した。|{k}では{w}が課題となっている。|{k}が{c}で{w}の公募を始めると発表した。|{k}と{w}の担当者が{c}に集まり、{w}を議論した。|{c}の{w}について、{k}は{w}の例を参考にした。|{k}の運営をめぐり、{w}と{w}の両立が問われている。|{f}賞の受賞作が決まった。|{f}記念館は{n}人を迎えた。|審議会の委員によれば、{w}の要件は{w}と{w}の二つだという。|委員会は{w}を議論した。""",
    "zh": """{c}公布{n}项{w}计划|{c}{w}时隔{n}年重开|第{n}届{c}{w}与{w}会议|登记号{n}-{n}已公布。|{w}的预算增长{n}.{n}％。|负责人说：“先做{w}。再做{w}。”随后离场。|《{w}。{c}卷》收录{n}件作品。|{w}……仍在等待{w}的结果。|{c}将{w}与{w}合并推进。|{w}还能坚持多久？|{c}公布第{n}批名单，{w}和{w}在列。|附件{n}（{n}KB）""",
    "ko": """{c} {w} {n}년 만에 재개|제{n}회 {c} {w} {w} 회의|등록번호 {n}-{n}|담당자는 “{w}를 지키자. 그다음은 {w}다.”라고 했다.|예산은 {n}.{n}억 원으로 {w}에 쓰인다.|{c}의 {w} 자료 No. {n}이 공개됐다.|{w}는 언제 열리나?|제{n}차 회의에서 {w} 안건이 통과됐다.|{c}는 {w}와 {w}를 함께 추진한다.""",
    "en": """{c} backs {w} and {w} with {n} grants|Meeting {n} of the {c} {w} board|{n} days of {w} in {c}: what the {w} lost|{c} Concert Hall reopens {w} wing after {n} years|Catalogue no. {n}-{n}-{n} was sold.|Lots {n}-{n} to {n}-{n} were withdrawn.|ISBN 978-0-{n}-{n}-0 is out of print.|Grant ref. QX {n}-{n} closed.|Room {n}, North Wing, reopened.|The {g} Prize went to {n} groups.|Seats @ {n} pounds went in {n} hours.|The {g} Foundation paid for the {w}.
Is the {w} in {c} safe with {n} staff?|Visitors ... and there were {n} of them ... preferred the {w}.|The U.K. loan of {w} papers vs. the {w} loan drew {n} letters.|A {w} draft names St. Orvel's {w} as a model.|Work on the {w} was let to Kell & Co.|{n} objects from the {w} went to {c} (see p. {n}).|No. {n} of the {w} series covers the {w} of {c}.|eMuse lists the {w} and the {w} of {c}.|Cookies, in the baking sense, paid for the {w} roof in {c}.|The {w} grant rose {n}.{n} per cent, the {w} grant did not.|The {c} council tied {w} funding to the {w} plan.|The {w}, e.g. the {w} wing, reopens at {n}.30 p.m. on Friday.|St. {g}'s church lent the {w}.|{g} & Sons built the {w}.|The {g} Gallery in {c} reopened.|(c) {n} {c} Review, all rights reserved|{c} Review is a trading name, registered office on request|By the {c} Review arts desk|{c} Review staff, updated {n} minutes ago""",
    "de": """{n}. Sitzung in {c}: {w} und {w}|{w} in {c} nach {n} Jahren zurück|{c} erweitert {w} um {n} Räume|Die {g}-Stiftung gab {n} Euro.|Inventarnummer {n}-{n}-{n} fehlt.|Rund {n},{n} Mio. Euro fließen in {w}.|Laut Abs. {n} der Satzung gilt {w} als Teil von {w}.|Am {n}. März öffnet {w} in {c}, z. B. mit {w}.|Die {n}. Auflage zu {w} kostet {n}.50 Euro.|Reicht {w} für {n} Gäste?|Der Rat von {c} beschloss, {w} und {w} zusammenzulegen.|Der {g}-Preis ging an {c}.""",
    "fr": """{w} : {c} retient {n} projets|{c} relance {w} après {n} ans|{n}e réunion de {c} sur {w} et {w}|Cote {n}-{n}-{n} du catalogue.|Le prix {g} attire {n} dossiers.|Le budget atteint {n},{n} M€ pour {w}.|L'art. {n} du texte vise {w}, cf. p. {n}, et {w}.|Quelle affluence autour de {w} à {c} !|Faut-il déplacer {w} vers {c} ?|La ville de {c} associe {w} et {w} dans un même plan.|La fondation {g} soutient {w}.""",
    "hi": """{c} में {n} वर्ष बाद {w} खुला|{c} {w} की {n}वीं बैठक|क्रमांक {n}-{n}|{n} नई वस्तुएँ {w} को मिलीं।|{c} में {w} और {w} पर चर्चा हुई।|क्या {w} समय पर खुलेगा?""",
    "ar": """الاجتماع {n} في {c} حول {w}|{c} تعيد {w} بعد {n} عاما|رقم {n}-{n}|وصل {n} زائرا إلى {w}!|ناقش مجلس {c} خطة {w} مع {w}.|هل يكفي {w} في {c}؟|بلغت الميزانية {n}.{n} مليون من أجل {w}.""",
    "th": """การประชุม{w}ครั้งที่ {n} ที่ {c}|{c} เปิด{w} {n} แห่ง|{w}ในเมือง {c} เปิดรับสมัคร {n} คน|{w}จะย้ายไปยัง {c} ในปีหน้า|ผู้อำนวยการกล่าวว่า “{w}ต้องอยู่ต่อไป” เมื่อวันที่ {n}|งบประมาณเพิ่มขึ้น {n}.{n} ล้านบาท เพื่อ{w}|คณะกรรมการพิจารณา{w}และ{w}ร่วมกัน""",
}
# What slots are made of.
NOUNS = {
    "ja": "壁画 写本 和紙 漆器 陶芸 染織 仏像 古文書 庭園 石垣 灯台 神楽 能楽 太鼓 祭礼 方言 絵巻 楽譜 映像 劇場 音楽堂 博物館 図書館 文化財 伝統工芸 民俗芸能 鉄道遺産 アーカイブ デジタル VR ICT 漫画原画 人形芝居 野外彫刻 木造建築 郷土食 酒蔵 茶室 町並み 子ども 学芸員 美術品 埋蔵品 紙資料 写真資料 現代美術 舞台芸術 地域文化 著作権 織物",
    "zh": "壁画保护 古籍修复 数字档案 民间音乐 文化遗产 地方戏曲 社区舞台 策展人才 公共图书馆 陶瓷工坊 版权登记 影像资料 艺术节 文化基金",
    "ko": "박물관 벽화복원 디지털자료 문화기금 방언조사 저작권 예술제 도자공방 기록보존 전통공예 민속음악 순회전시 학예인력 공공도서관",
    "en": "library archive mural textile pottery charter loan grant theatre festival museum curator restoration catalogue exhibition dialect heritage manuscript workshop audience",
    "de": "Museum Archiv Theater Bibliothek Wandbild Handschrift Satzung Zuschuss Leihgabe Katalog Werkstatt Festspiel Mundart Denkmal Keramik",
    "fr": "musée archives théâtre bibliothèque fresque manuscrit charte subvention prêt catalogue atelier festival dialecte patrimoine céramique",
    "hi": "पुस्तकालय संग्रहालय भित्तिचित्र पांडुलिपि अनुदान उत्सव रंगमंच विरासत कार्यशाला अभिलेखागार",
    "ar": "المكتبة المتحف الجدارية المخطوطة المنحة المهرجان المسرح التراث الورشة الأرشيف",
    "th": "ห้องสมุด พิพิธภัณฑ์ จิตรกรรมฝาผนัง ต้นฉบับ เงินอุดหนุน เทศกาล โรงละคร มรดกวัฒนธรรม หอศิลป์",
}
ENDS = "活用 保存 展示 修理 調査 研究 公開 招致 入札 会議 育成 継承 予算 基金 条例 計画 補助金 助成 講座 教室 翻訳 記録 改修 整備 防災 審査 登録 指定 観光 配信 上演 収蔵 評価 循環 連携 普及 広域 振興 運営 交流 体験 教育 福祉 医療 建設 輸送 販売 開発 支援 協議 管理 分析 鑑賞 制作 演奏 出版".split()
HALLS = "図書館 美術館 博物館 資料館 文書館 郷土館 民芸館 文化会館 芸術劇場 音楽ホール".split()
TOWNS = "本町 東 港 西 緑町 中央 桜台 北 栄町 南 若葉台 大手町 新町 上野 駅前通 元町 富士見".split()
JA_FAMILY = "鈴木 伊藤 中村 加藤 吉田 山田 佐々木 山口 松本 井上 木村 林 斎藤 清水 山崎 森 池田 橋本 阿部 石川 前田 藤田 小川 後藤 岡田 近藤 村上 遠藤 青木 坂本 斉藤 福田 太田 西村 藤井 金子 岡本 藤原 中野 三浦 原田 松田 竹内 上田 中山 和田 森田 小野寺 佐久間 早乙女 西園寺 勅使河原 佐藤 高橋 田中 山本 渡辺 小林 長谷川 石笛 藤衣  波多野 五十嵐 大河原".split()
JA_GIVEN = "太郎 次郎 翔 大輔 拓也 健太 直人 浩 茂 明 陽子 恵子 由美 愛 優子 真由美 久美子 結衣 陽菜 葵 凛 蓮 悠真 湊 大翔 ゆい あおい はるか まこと けん 龍之介 新之助 小百合 花子 健一 さくら 美咲 誠 隆之 瑞希 めぐみ かなえ 颯 千尋 直樹".split()
ZH_FAMILY, ZH_GIVEN = "王李张刘陈杨黄赵周吴徐孙马朱胡林郭何高罗", "伟 芳 娜 秀英 敏 静 丽 强 磊 军 洋 勇 艳 杰 涛 超 秀兰 霞 平 桂英 晓东 海燕 志强 雪梅 文博 天宇 建国 小雨 子涵 明 思远 嘉宁".split()
KO_FAMILY, KO_GIVEN = "김이박최정강조윤장임한오서신", "민수 영희 철수 지훈 수빈 예진 도윤 하은 현우 은주 성호 미영 지우 하늘 민준 서연 다온".split()
EN_FAMILY = "Smith Jones Taylor Brown Williams Wilson Johnson Davies Patel Robinson Wright Thompson Evans Walker White Roberts Green Hall Wood Jackson Clarke Harris Lewis Clark Young King Baker Carter Mitchell Turner Parker Collins Cook Murphy Bailey Cooper Reed Kelly Howard Ward Price Bennett Gray Watson Brooks Kaur Khan Nguyen Garcia Martinez Lopez Rossi Bianchi Novak Kowalski Ivanova Andersson Hansen Virtanen Papadopoulos Silva Santos O'Brien MacDonald".split()
DE_FAMILY = "Müller Schmidt Schneider Fischer Weber Wagner Becker Schulz Hoffmann Koch Bauer Richter Klein Wolf Schröder Neumann Schwarz Zimmermann Braun Krüger Hofmann Hartmann Lange Krause Lehmann Köhler Maier Huber Vogel Yılmaz".split()
FR_FAMILY = "Martin Bernard Thomas Petit Robert Richard Durand Dubois Moreau Laurent Simon Michel Lefebvre Leroy Roux David Bertrand Morel Fournier Girard Bonnet Dupont Lambert Fontaine Rousseau Vincent Faure Mercier Blanc Guérin Benali".split()
EN_GIVEN = "James Mary John Patricia Robert Jennifer Michael Linda David Elizabeth William Susan Richard Jessica Joseph Sarah Thomas Karen Daniel Nancy Matthew Lisa Anthony Margaret Mark Sandra Paul Ashley Steven Emily Andrew Donna Kenneth Michelle George Carol Joshua Amanda Kevin Olivia Brian Emma Edward Grace Amir Fatima Wei Aisha Ravi Sunita Carlos Lucia Giulia Marek Ana".split()
DE_GIVEN = "Hans Anna Peter Ursula Klaus Monika Jürgen Petra Stefan Sabine Andreas Julia Markus Katrin Jonas Lena Lukas Lea Felix Greta Uwe Heike Emre Björn".split()
FR_GIVEN = "Jean Marie Pierre Nathalie Michel Isabelle Philippe Sylvie Nicolas Catherine Julien Camille Antoine Chloé Hugo Manon Louis Inès Émile Zoé Benoît Amélie Karim Léa".split()
HI_NAMES = "प्रिया रमन|सुनील वर्मा|अनीता शर्मा|राजेश गुप्ता|कविता सिंह|मोहन|आशा पटेल".split("|")
AR_NAMES = "أحمد حسن|فاطمة علي|محمود سعيد|ليلى خليل|عمر يوسف|نادية|سامي منصور".split("|")
TH_NAMES = "สมชาย ใจดี|มาลี ศรีสุข|ประเสริฐ|วิภา ทองคำ|อนันต์ รักไทย|สุดา".split("|")
PLACE_HEADS = "Ash Brad Clif Dun Elm Font Glen Hart Kings Lang Mill New Oak Port Red Salt Thorn Under West Wood Yama Kawa Naka Mina Ishi Oka Matsu Hama".split()
PLACE_ENDS = "ford ham ton bury dale field mouth berg ville stadt hausen gawa saki moto zaki".split()
#: Letters that names are made of.
FAMILY_LETTERS = "山川田村野木林森石藤高松井上下中大小西東北南原島崎沢谷坂池宮橋岡本内水金竹杉梅桜菊浜岸浦津江戸河星月雲霧露霜雪風波渡葦葉桐椿柳栗鈴笛琴弓矢白黒赤青古新長平"
GIVEN_LETTERS = "太一二郎子美男雄夫介也人仁信義誠智明光春夏秋冬花香菜葵蓮海空陽月星夢愛優真由奈里佳恵和幸健康大翔悠凪澄汐帆弦朔灯紗織梢結衣音乃希斗馬"
KO_LETTERS = "가나다라마바사아자하거너더러미비시지구누두루무부수주라래로솔담빛새봄별달"
STREETS = "High|Mill|Harbour|Church|Station|Orchard|Weaver|Long Meadow|King George|Victoria|Elm|Chestnut|Upper Park|Copperfield".split("|")
STREET_KINDS = "St.|Street|Row|Lane|Road|Rd.|Avenue|Ave.|Close".split("|")
DE_STREETS = "Hauptstr.|Mühlenstraße|Bahnhofstraße|Lindenallee|Gartenweg|Schulgasse|Rathausplatz|Am Markt|Rosentor|Birkenhag|Feldweg".split("|")
FR_STREETS = "rue de la Paix|rue des Petits-Champs|quai du Port|avenue de la Gare|chemin du Moulin|place des Halles|boulevard Nord|rue Vieille|allée des Tilleuls".split("|")
MAIL_HOSTS = "mail post web.office city-hall shop school.north clinic kaisha machi tenpo sales.team hotel".split()
MAIL_ENDS = "test example invalid example.jp com org co.jp net de".split()
PHONES = "0###-##-####|00##-##-####|03-####-####|(03)####-####|06-####-####|090-####-####|090 #### ####|080-####-####|0800.0##.####|0120-###-###|0300######|+81 3 #### ####|+81-90-####-####|+44 1632 960 ###|01632 960###|01632-960-###|020 7946 0###|555-01##|(212) 555-01##|212-555-01##|+1 646.555.01##|01 99 00 ## ##|01.99.00.##.##|+33 1 99 00 ## ##|030 23125 ###|(030) 23125###|+49 30 23125-###|02-###-####|+82 2 #### ####|138 #### ####".split("|")
IDS = {
    "ij": "個人番号 マイナンバー 個人番号カードの番号:#### #### ####|####-####-####|############;運転免許証の番号 免許証番号:00##########|############;旅券番号 パスポート番号:ZZ#######|TR#######",
    "iz": "身份证号 身份证号码:000000############|##################;护照号:E########",
    "ik": "주민등록번호:000000-#######|######-#######",
    "ie": "NI~no. National~Insurance~number:QQ ## ## ## C|QQ######A|AB ## ## ## D;passport~no. passport~number:ZZ#######|#########;SSN social~security~number:9##-##-####|###-##-####",
    "id": "Ausweisnummer:## ### ### ###|L0#######;Steuer-ID:## ### ### ###|###########",
    "if": "numéro~de~sécurité~sociale:# ## ## ## ### ### ##|#############;numéro~de~passeport:##AB#####",
}


class Filler:
    """Fills one carrier: text and spans (start, end, kind)."""

    def __init__(self, rng: random.Random):
        self.rng = rng

    def digits(self, form: str) -> str:
        return "".join(str(self.rng.randrange(10)) if ch == "#" else ch for ch in form)

    def wide(self, text: str, share: float = 0.15) -> str:
        if self.rng.random() >= share:
            return text
        return "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" and c not in "." else c for c in text)

    def made_up(self) -> str:
        """A capitalised word of two or three syllables, as a name that no list holds."""
        r = self.rng
        parts = [r.choice("B C D F G H J K L M N P R S T V W Z Br Dr Fr Gr Kr Pr Tr St Sk Th Ch Sh Qu Wh".split()).lower() + r.choice("a e i o u ai ei ou".split()) + r.choice(["", "", "n", "r", "l", "s", "m", "ck", "rd", "nt", "sk", "lm", "x"]) for _ in range(r.choice([1, 2, 2, 2, 3]))]
        return ("".join(parts) + r.choice(["", "", "", "by", "er", "ton", "mine", "ley", "in", "a", "o", "is", "holt", "wick", "anne", "elle"])).capitalize()

    def latin_name(self, lang: str) -> str:
        r = self.rng
        families, givens = {"de": (DE_FAMILY, DE_GIVEN), "fr": (FR_FAMILY, FR_GIVEN)}.get(lang, (EN_FAMILY, EN_GIVEN))
        family = self.made_up() if r.random() < 0.65 else r.choice(families)
        given = self.made_up() if r.random() < 0.5 else r.choice(givens)
        form = r.choice(["{g} {f}"] * 5 + ["{f}"] * 4 + ["{f}, {g}", "{i}. {f}", "{g} {i}. {f}"])
        name = form.format(f=family, g=given, i=given[0])
        return name.upper() if r.random() < 0.2 and " " in name else name

    def family(self, lang: str) -> str:
        if lang == "ja":
            return self.rng.choice(JA_FAMILY) if self.rng.random() < 0.5 else "".join(self.rng.sample(FAMILY_LETTERS, 2))
        return self.made_up() if self.rng.random() < 0.6 else self.rng.choice(EN_FAMILY)

    def letters(self, of: str, n: int) -> str:
        """n letters, of the usual ones or, now and then, of all ideographs, so that what stands around a name has to tell it."""
        r = self.rng
        return "".join(chr(r.randrange(0x4E00, 0x9FA5)) if r.random() < 0.3 else r.choice(of) for _ in range(n))

    def person(self, lang: str) -> str:
        r = self.rng
        if lang == "ja":
            family = r.choice(JA_FAMILY) if r.random() < 0.4 else self.letters(FAMILY_LETTERS, r.choice([2, 2, 2, 3, 3, 4]))
            given = r.choice(JA_GIVEN) if r.random() < 0.4 else self.letters(GIVEN_LETTERS, r.choice([1, 2, 2, 3]))
            return family if r.random() < 0.2 else family + r.choice(["", "", "", " ", "　"]) + given
        if lang == "zh":
            return (r.choice(ZH_FAMILY) if r.random() < 0.6 else r.choice(FAMILY_LETTERS)) + (r.choice(ZH_GIVEN) if r.random() < 0.6 else "".join(r.sample(GIVEN_LETTERS, r.choice([1, 2]))))
        if lang == "ko":
            return (r.choice(KO_FAMILY) if r.random() < 0.6 else r.choice(KO_LETTERS)) + (r.choice(KO_GIVEN) if r.random() < 0.5 else "".join(r.sample(KO_LETTERS, 2)))
        own = {"hi": HI_NAMES, "ar": AR_NAMES, "th": TH_NAMES}.get(lang)
        return r.choice(own) if own and r.random() < 0.4 else self.latin_name(lang)

    def place(self, lang: str) -> str:
        r = self.rng
        if lang in ("ja", "zh"):
            return "".join(r.sample(FAMILY_LETTERS, r.choice([1, 2, 2]))) + r.choice(["", "", "野", "川", "谷", "沢", "原", "浜"]) + r.choice("市町村区")
        return r.choice(PLACE_HEADS) + r.choice(PLACE_ENDS)

    def mail(self) -> str:
        r = self.rng
        name = r.choice(["info", "desk", "press", "hello", "sales", "jimu"]) + r.choice(["-x", "+list", "_team", "-office", "", str(r.randrange(99))]) if r.random() < 0.5 else r.choice([re.sub("[^a-z]", "", r.choice(EN_GIVEN).lower())  + r.choice([".", "", "_"]) + r.choice([self.made_up().lower(), str(r.randrange(99))])])
        host = r.choice(MAIL_HOSTS) + "." + r.choice(MAIL_ENDS)
        form = r.random()
        if form < 0.75:
            return f"{name}@{host}"
        if form < 0.8:
            return f"{name}＠{host}"
        if form < 0.85:
            return f"{name}★{host}"
        if form < 0.92:
            return f"{name}{r.choice(['(at)', ' (at) '])}{host}"
        return f"{name} [at] " + host.replace(".", " [dot] ")

    def address(self, lang: str) -> str:
        r = self.rng
        n = lambda top=40: str(r.randrange(1, top))
        if lang == "ja":
            post = r.choice(["", "", "〒" + self.wide(self.digits("###-####"), 0.3) + " "])
            lot = r.choice([f"{n(9)}丁目{n()}−{n()}", f"{n(9)}-{n()}-{n()}", f"{n()}番地の{n()}", f"{n()}番地", r.choice("一二三四五六七") + f"丁目{n()}番{n()}号", f"{n(9)}-{n()}", "字" + self.place("ja")[:2] + n()])
            return post + r.choice(["", "", "", "青山県"]) + self.place("ja") + r.choice(TOWNS) + self.wide(lot, 0.1) + r.choice(["", "", "", "中央ビル3階", " 緑荘201号"])
        if lang == "zh":
            place = self.place("zh")
            return place + place[:2] + r.choice(["路", "街", "大道"]) + n() + "号" + r.choice(["", n() + "室", n() + "楼"])
        place = self.place("en")
        if lang == "de":
            return r.choice([f"{r.choice(['Am ', 'An der ', ''])}{r.choice(DE_STREETS)} {n()}{r.choice(['', 'a', 'b'])}{r.choice([', ' + self.digits('00###') + ' ' + place, ' in ' + place])}"])
        if lang == "fr":
            return f"{n()}{r.choice([',', ' bis,', ' ter,'])} {r.choice(FR_STREETS)}, {self.digits('00###')} {place}"
        street = f"{n(400)} {r.choice(STREETS)} {r.choice(STREET_KINDS)}"
        return r.choice([f"Flat {n()}, {street}, {place} {r.choice(["ZZ", "NW", "LS", "M"])}{n(20)} {n(9)}{r.choice(["ZZ", "AB", "QT"])}", f"{street}, Apt. {n()}, {place}", f"{street}, {place}", f"{street}, {place}, {self.digits('#####')}"])

    def identity(self, slot: str) -> tuple[str, str]:
        label, forms = self.rng.choice(IDS[slot].split(";")).split(":")
        return self.rng.choice(label.split(" ")).replace("~", " "), self.wide(self.digits(self.rng.choice(forms.split("|"))), 0.12)

    def fill(self, carrier: str, lang: str) -> tuple[str, list[tuple[int, int, str]]]:
        out, spans = "", []
        for part in carrier.replace("}", "{").split("{"):
            kind = value = None
            if part == "P":
                kind, value = "person", self.person(lang)
            elif part == "E":
                kind, value = "email", self.mail()
            elif part == "T":
                kind, value = "phone", self.wide(self.digits(self.rng.choice(PHONES)))
            elif part == "A":
                kind, value = "address", self.address(lang)
            elif part in IDS:
                label, value = self.identity(part)
                kind = "id_number"
                out += label + (self.rng.choice(["は", "：", " ", ""]) if part == "ij" else self.rng.choice(["", "：", " "]) if part == "iz" else " ")
            elif part == "w":
                value = self.rng.choice(NOUNS[lang].split()) + (self.rng.choice(ENDS) if lang == "ja" and self.rng.random() < 0.8 else "")
            elif part == "c":
                value = self.place(lang)
            elif part == "h":
                value = self.rng.choice(HALLS)
            elif part == "l":
                value = self.place("ja")[:-1] + self.rng.choice(FAMILY_LETTERS) + self.rng.choice(["織", "凧", "祭", "漬", "面", "唄", "講", "座", "窯", "太鼓", "踊り", "一揆", "神事", "市", "塚", "石仏", "筆", "焼"])
            elif part == "k":
                hall = "".join(self.rng.sample(FAMILY_LETTERS, 2))
                value = self.rng.choice([hall + self.rng.choice(HALLS), hall + "の" + self.rng.choice(HALLS), hall + self.rng.choice("博美"), self.place("en") + self.rng.choice([" Gallery", " Museum", " Playhouse", " Library", " Arts Hall", " Record Office", " Craft House"])])
            elif part == "f":
                value = self.family("ja")
            elif part == "g":
                value = self.family("en")
            elif part == "n":
                value = str(self.rng.randrange(1, self.rng.choice([10, 100, 1000, 10000])))
            elif part == "d9":
                value = self.digits("###") * 3
            else:
                value = part
            if kind:
                spans.append((len(out), len(out) + len(value), kind))
            out += value
        return out, spans


def _split(block: str) -> list[str]:
    return [c for line in block.split("\n") for c in line.split("|")]


def labelled_table(per_carrier: int = 24, seed: int = 11, corpus: bool = True) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """Sentences with their mentions: each carrier filled per_carrier times, some joined with a neighbour on one line.

    corpus: with the forms labelled in the corpus, else the general ones alone. The table is bounded by per_carrier and
    the number of carriers, about 600.
    """
    rng = random.Random(seed)
    filler = Filler(rng)
    rows = []
    for lang in CARRIERS:
        with_mentions, plain = _split(CARRIERS[lang]), _split(PLAIN[lang])
        if corpus:
            with_mentions, plain = with_mentions + _split(CORPUS_CARRIERS[lang]), plain + _split(CORPUS_PLAIN[lang])
        joint = "" if lang in ("ja", "zh") else " "
        for carrier in with_mentions * per_carrier + plain * max(1, per_carrier // 2):
            text, spans = filler.fill(carrier, lang)
            if not spans and lang in ("en", "de", "fr") and rng.random() < 0.08:
                text = text.upper()
            if rng.random() < 0.45:
                more, others = filler.fill(rng.choice(with_mentions if rng.random() < 0.4 else plain), lang)
                at = len(text) + len(joint)
                text, spans = text + joint + more, spans + [(at + a, at + b, k) for a, b, k in others]
            rows.append((text, spans))
    rng.shuffle(rows)
    return rows
