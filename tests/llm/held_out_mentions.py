"""Sentences of other forms and names than any the tagger is trained on, with persons in {} and other mentions in []."""

SENTENCES = """Our volunteer coordinator is {Priya Raman}, and she never sleeps.
The bakery on the corner belongs to {Tom Ashworth}.
Yesterday {Claire Fontaine} handed in her thesis.
Thank you, Dr {Okonkwo}, for coming.
Minutes taken by {Hannah Lindqvist}; apologies from {Raj Malhotra}.
The keynote was given by {Maria da Costa} in the afternoon.
Goalkeeper {Liam Gallagher} saved two penalties.
You can reach {Ben Sharpe} at [b.sharpe@nordwerk.example] until noon.
My number is [+44 20 7946 0123], leave a message.
In 1987 {Walter Kovacs} founded the choir.
{Elena Petrova} plays the viola and {Jun Tanaka} the piano.
Detective {Sarah Linden} closed the case.
The mayor, {Anita Gupta}, cut the ribbon.
Poems by {Emily Hartwell} were read aloud.
{山田太郎}という人が来ました。
昨夜、{高橋美穂}さんが優勝した。
部長の{中島健吾}が謝罪した。
担当の{三宅}までご連絡ください。
料理研究家の{土井善子}さんに聞く。
弁護士の{大島浩司}氏は控訴する方針だ。
{岩崎真理}教授らの研究チームが発表した。
投手の{前川翔太}が完封した。
新会長に{水野俊介}氏が就任した。
母の{和子}さんは涙を流した。
私は{黒田真一}と申します。
俳優の{宮本あかり}さんが登場した。
{王小明}先生昨天来过。
记者{陈思雨}报道。
经理{赵国华}已经同意。
歌手{李晓霞}将举行演唱会。
{김지영} 대표가 말했다.
배우 {이수진} 씨가 참석했다.
감독 {박준호} 씨는 웃었다.
Gestern gewann {Jonas Feldmann} das Rennen.
Die Ärztin {Sabine Krüger} hilft weiter.
Laut Trainerin {Petra Vogt} war es knapp.
Herr {Hans Meier}, bitte kommen Sie.
Hier soir, {Antoine Lefèvre} a gagné.
La maire, {Sophie Garnier}, coupe le ruban.
Merci à {Juan Pérez} pour la photo.
Le violoniste {Marc Delorme} jouera demain.
Ruf mich an: [030 23125 778].
Mi correo es [juan.perez@correo.example].
本店の電話は[03-5555-0142]です。""".split("\n")


def parsed():
    """(text, [(kind, start, end)]) of each sentence."""
    out = []
    for line in SENTENCES:
        text, spans, begun = "", [], None
        for ch in line:
            if ch in "{[":
                begun = len(text)
            elif ch in "}]":
                kind = "person" if ch == "}" else "email" if "@" in text[begun:] else "phone"
                spans.append((kind, begun, len(text)))
            else:
                text += ch
        out.append((text, spans))
    return out
