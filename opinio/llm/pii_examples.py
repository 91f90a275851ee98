"""Small labelled table for the personal-data model: lines with their spans marked ``{kind|span}``.

Written for this library.  Lines without a mark are as important as the others: numbers, codes and dates that look
like personal data and are none.  ``\\n`` stands for a line break (in lines without a mark only).
"""

LINES = r"""
Write to {email|alice at example dot com} before Friday.
My address is {email|bob [at] mail [dot] org}, please use it.
Contact: {email|carol(at)uni-bonn.de}
You can reach {email|dave AT corp DOT net} any time.
e-mail: {email|frank @ example . org}
Send it to {email|g.miller (at) post (dot) com} today.
Mail an {email|heidi (at) firma.de} genügt.
Adresse : {email|jean [at] exemple.fr}
Escriba a {email|luis arroba correo punto es} por favor.
reply to {email|ivan_77 at server dot co dot uk}!
{email|judy at data dot io} wrote this page.
Ask {email|mallory{at}box{dot}com} about it.
please contact {email|nina.k at lab dot edu} or call
Email {email|oscar@mail.example.com} or visit us.
Her mail is {email|peggy.s+news@list.example.org}.
kontakt {email|trent@firma-nord.de}, danke
Email: {email|victor [at] shop.example.com}
He signs as {email|walter at hill dot example dot net}.
Our server is {ip|192[.]168[.]0[.]1} for now.
blocked {ip|10[.]20[.]30[.]40} again
The host {ip|203 . 0 . 113 . 9} did not answer.
Login from {ip|198.51.100.23} failed.
address {ip|fe80::1ff:fe23:4567:890a} on eth0
ping {ip|2001:db8:0:1:1:1:1:1} works
client {ip|172.16.254.3} connected
Requests from {ip|8(.)8(.)4(.)4} were dropped.
from {ip|192(dot)0(dot)2(dot)44} came noise
The gateway at {ip|10.0.0.138} is slow.
source ip {ip|198[.]51[.]100[.]77} seen twice
Pay with card {card|4111.1111.1111.1111} please.
Visa {card|4000/1234/5678/9010} expires soon.
card no. {card|5500_0000_0000_0004} was charged
My card is {card|4111 1111 1111 1111}, use it.
Karte {card|5105.1051.0510.5100} gesperrt
card number: {card|3714.496353.98431}
MasterCard {card|5555/5555/5555/4444} accepted
la carte {card|4012.8888.8888.1881} est perdue
tarjeta {card|4222_2222_2222_2220} robada
the card {card|6011 0009 9013 9424} is mine
Call me at {phone|555-123-4567} tonight.
Tel. {phone|030 1234567} ab neun Uhr.
Phone: {phone|(212) 555-0187}
Ring {phone|0171/2345678} or write.
Telefon {phone|0043 1 58858 0} im Büro
Call {phone|1-800-555-0199} for help.
tel {phone|01 44 55 66 77} le matin
mobile {phone|07700 900123} only
Fax: {phone|(030) 123-4567}
Llame al {phone|91 123 45 67} mañana.
phone {phone|212.555.0142} after six
My number is {phone|(415) 555-0123}, thanks.
Text {phone|555 0100 200} when there.
Handy {phone|0151 23456789} an
Reach us on {phone|+44 20 7946 0958} daily.
dial {phone|+1 (017) 555-7713} now
téléphone {phone|06.12.34.56.78} merci
The office phone is {phone|617-555-0134}.
call {phone|0800 555 111} toll free
WhatsApp {phone|+49 151 2345678}
Write to {email|anna at mail dot net} or to the office.
mail me: {email|tom.b at inbox dot org}
Contact {email|sara at school dot edu} for details.
questions to {email|max at firma dot de} please
{email|li.wei at uni dot cn} has the data
Just ask {email|zoe at example dot com}.
info: {email|peter dot smith at example dot com}
write {email|r2d2 at robots dot net} today
reach {email|kim_lee at studio dot com}, thanks
Contact: {email|maria [at] post [dot] at}
send to {email|joe [at] site [dot] com} now
email {email|eva.k [at] web [dot] de}!
The author ({email|noah [at] lab [dot] org}) knows.
Contact {email|paul (at) mail (dot) com} about this.
Ask {email|lena.w (at) box (dot) net} instead.
via {email|omar (at) host (dot) org}
Contact: {email|rita(at)web.de}
mailto {email|ben(at)post.example.com}
see {email|u.meyer(at)stadt-koeln.de}
Write {email|ann AT site DOT com} soon.
reach me: {email|carl.d AT mail DOT org}
answers to {email|fred @ mail . com}
mail: {email|gina @ post . net} please
to {email|hugo @ server.org} only
an {email|inge [at] verein.de} senden
to {email|karl[at]mail[dot]com} again
from {email|lisa[at]office[dot]net} today
mail {email|mia{at}web{dot}de} please
ask {email|ned{at}site{dot}org} for it
escribe a {email|pepe arroba mail punto com}
correo {email|rosa arroba casa punto es} gracias
host {ip|10[.]1[.]2[.]3} was scanned
the bot at {ip|185[.]220[.]101[.]5} tried again
see {ip|45[.]33[.]32[.]156} in the log
blocked {ip|91[.]198[.]174[.]192}, thanks
The router {ip|192 . 168 . 2 . 1} is down.
server {ip|10 . 0 . 0 . 5} is up
ping {ip|172 . 16 . 4 . 20} first
from {ip|1(.)1(.)1(.)1} and others
at {ip|9(.)9(.)9(.)9} again
address {ip|10(dot)2(dot)3(dot)4} is blocked
host {ip|77(dot)88(dot)8(dot)1} answered
address {ip|2001:db8:85a3:0:0:8a2e:370:7334} is new
route to {ip|2a00:1450:4001:82b:0:0:0:200e} lost
host {ip|fe80::200:5aff:feaa:20a2} up
from {ip|fd12:3456:789a:1::1} today
neighbour {ip|fe80::a00:27ff:fe4e:66a1} found
login from {ip|203.0.113.77} at night
card {card|4539.1488.0343.6467} was declined
Visa {card|4485/2757/4230/8327} is mine
card {card|5425_2334_3010_9903} works
Amex {card|3782.822463.10005} accepted
card number {card|4716.1088.5971.6299} on file
Karte {card|4556/7375/8689/9855} abgelaufen
credit card: {card|4024_0071_0902_2143}
MasterCard {card|5200.8282.8282.8210} ok
carte {card|4970/1012/3456/7890} bloquée
amex card {card|3787.344936.71000} lost
Call {phone|212-555-0156} today.
Call me on {phone|646-555-0199} please.
phone {phone|303-555-0177} or mail
Phone: {phone|(312) 555-0143}, ask for Ann
reach us at {phone|(503) 555-0110}
office {phone|(202) 555-0175} until five
Tel. {phone|040 7654321} nur abends
Tel.: {phone|089 9876543}
Telefon {phone|0221 443322} werktags
Ring {phone|0172/8765432} please.
Handy {phone|0160/1122334}
mobile {phone|07911 123456} always
mobile {phone|07700 900456} at night
Handy {phone|0176 98765432} abends
tel {phone|01 42 33 44 55} bureau
téléphone {phone|04 91 22 33 44} le soir
tel {phone|06.98.76.54.32} mobile
téléphone {phone|01.23.45.67.89} standard
phone {phone|415.555.0178} any time
call {phone|646.555.0121} now
Llame al {phone|93 765 43 21} hoy.
Call {phone|1-888-555-0133} free.
call {phone|1-877-555-0190} toll free
Telefon {phone|0049 30 223344 0} Zentrale
Telefon {phone|0041 44 6681800} Zürich
toll free {phone|0800 111 222}
It was built in 1998 and 2004.
Version 4.0 replaced version 3.2.1 last year.
Licensed under CC BY 4.0.
Published under the General License, version 3.
The price fell from 1,299.00 to 999.95 dollars.
Order 4539578763621486 was shipped.
Code 9807915762804490 means nothing.
Number 20240131093000123 is a time stamp.
token = "b44e15e09fd311c3cf3163b66d5a9875b883d8ce"
key: 7f3a9c1e55d04b8892aa
commit 269b1cea0846965f2d3ecb5cdb87c0edc7a7a587 fixes it
On 12.05.2021 we met at 14:30 in room 212.
See pages 12-14 and 20-22 of chapter 3.
The score was 3:2 after 90 minutes.
He ran 100 m in 10.4 seconds.
ISBN 978-3-16-148410-0 is out of print.
The ratio is 1:1000000 on this map.
From 2019-04-01 to 2020-03-31.
Section 1.2.3.4.5 of the manual
build 10.0.19045 on windows
We sat at the table and talked about it.
Look at the dot on the map.
The dot com boom ended at last.
They arrived at noon at the station.
a dot and a dash at the end
Meet me at home at eight.
The rain in the north was heavy and cold.
Die Stadt liegt am Fluss und ist alt.
La maison est grande et le jardin petit.
El perro corre por la calle larga.
WE WENT HOME!! AND SLEPT!! ALL DAY!!
words%%% and### more$$$ words&&& here***
5927243074273351!! OF!! THEM!!
und 9000426309966109$$$ der&&&
"269b1cea0846965f2d3ecb5cdb87c0edc7a7a587"### of%%%
Copyright 2001-2015 all rights reserved.
x = 3 * (4 + 5) - 12 / 7
Take 2 cups of 500 ml and 3 eggs.
RFC 2616 and RFC 793 are old.
The file has 123456789 lines.
account 1234567 is closed
Room 101, floor 7, building 12
temperature -12.5 at 1013.2 hPa
player 23 scored 45 points in 67 games
bits 0101 1100 1010 0011 were sent
1 2 3 4 5 6 7 8 9 10
2. Second item (see 4.1)
(a) first (b) second (c) third
the years 1914 1918 1939 1945 in order
https://www.example.com/path?id=123456
www.example.org is a site
twitter user @someone said hi
@media and @import are rules
f(x) @ g(x) = 0
user@ is not complete
price: 5 @ 3.20 each
std::vector<int> and a::b::c
time 10:20:30:40 on the tape
mac 00:1b:44:11:3a:b7 of the card
ratio 16:9 or 4:3 screens
the card game lasted an hour
a phone call about the phone
she sent an email and a card
his address at work changed
the ip law of the country
call number QA76.73 on the shelf
line 555 of file 0123
call 911 in an emergency
phone model 3310 from 2000
version 10.15.7 (19H2026)
serial SN-4481-2290-XK
invoice 2021/0045/77 is due
sku 4400-1200-88 sold out
the 4.5.6.7.8 release
5.10.2 and 6.1.0-rc3 kernels
They ran home.\nAt noon we left.
Fin de la route.\nDe loin on voit la mer.
We stayed.\nAt last it stopped, at night.
Es la verdad.\nDe nuevo en casa.
Sie kam an.\nDer Zug war weg.
at at at at the end
look at that at once
he looked at her, at them and at us
All at sea.\nAndrew said no.
Las casas.\nLos perros de la calle.
point de vue de la ville
punto de encuentro en la plaza
I sat at home. Then we ate.
one.\nAt two.\nAt three.
stop at the shop in town
He was at Example Street then.
dot dot dot and so on
paid 1,250.50 and 300.75 in cash
between 10.5 and 99.9 percent
from 1,000 to 2,500.00 in all
https://example.org/a/b/c and more
http://www.site.net/index.html
see www.mail.com or www.site.org
Order 6011000990139424 was sent.
order 5105105105105100 arrived
Paragraph 2.3.4.5.6 applies
section 10.2.1.3.9 says no
the 1.2.3.4.5.6 build
version 2.4.10.77.3 is out
lot 4455-2210-9 and lot 2231-9910-7
model 5500/4400 from 2012
code 1234 5678 is wrong
id 4433221100 not found
row 1122334455667788 is empty
case 2020-0344-11 was closed
"""


def rows() -> list[tuple[str, list[tuple[int, int, str]]]]:
    """``(text, spans)`` of every line, spans as ``(start, end, kind)``."""
    out = []
    for line in LINES.strip().split("\n"):
        text, spans, at = "", [], 0
        while (mark := min((line.find("{" + k + "|", at) for k in ("email", "ip", "card", "phone")
                            if line.find("{" + k + "|", at) >= 0), default=-1)) >= 0:
            kind, _, rest = line[mark + 1:].partition("|")
            depth, n = 1, 0
            while depth:
                depth += {"{": 1, "}": -1}.get(rest[n], 0)
                n += 1
            text += line[at:mark]
            spans.append((len(text), len(text) + n - 1, kind))
            text += rest[:n - 1]
            at = mark + 2 + len(kind) + n
        out.append(((text + line[at:]).replace("\\n", "\n"), spans))
    return out
