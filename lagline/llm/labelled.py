"""A small table of chains labelled by hand, for personal data that the fixed patterns miss.

``[[kind|words]]`` marks a span; everything else, look-alikes included, is none. All names, numbers
and secrets are made up.
"""

from __future__ import annotations

import re

MARK = re.compile(r"\[\[(\w+)\|(.*?)\]\]")

LINES = """
write to [[email|jane (at) corp (dot) com]] before monday
mail [[email|ravi [at] shop [dot] org]] for the form
contact [[email|lee.wong (at) mail.example.net]] with questions
reach me under [[email|sam dot hill at quick dot net]] any day
my address is [[email|olga at river dot example dot org]] thanks
send it to [[email|tom(at)garden(dot)com]] please
email: [[email|maria[at]posta[dot]es]] or by letter
the author is [[email|k.meyer (at) uni (dot) de]] in spring
ask [[email|help @ store.example.com]] about it
ask [[email|info @ lake.org]] about refunds
user [[email|root@localhost]] logged in
login as [[email|admin@server]] on the box
call [[phone|(826) 555-4081]] after six
call us at [[phone|826-555-4081]] today
phone [[phone|555.203.9981]] or come by
tel. [[phone|030 2094 5512]] in berlin
tel: [[phone|0171 555 0192]] evenings
fax [[phone|(0)20 7946 0958]] for orders
mobile [[phone|0044 7700 900123]] only texts
my number is [[phone|212 555 0147]] thanks
ring [[phone|001-415-555-0132]] first
telephone [[phone|06 12 55 01 98]] in paris
whatsapp [[phone|(11) 95555-0143]] in brazil
dial [[phone|1-800-555-0199]] for free
from host [[ip|10 . 20 . 30 . 40]] last night
blocked [[ip|192[.]168[.]7[.]21]] in the firewall
traffic to [[ip|203[.]0[.]113[.]9]] was dropped
address [[ip|198(.)51(.)100(.)7]] is listed
server [[ip|172-16-254-3]] went down
ping [[ip|fe80::1ff:fe23:4567:890a]] works
route to [[ip|2001:db8:85a3::8a2e:370:7334]] is up
host [[ip|2001:db8:0:1:1:1:1:1]] answered
card [[card|4111.1111.1111.1111]] was charged
visa [[card|4111_1111_1111_1111]] declined
paid with [[card|4111/1111/1111/1111]] online
card number [[card|5500.0000.0000.0004]] on file
mastercard [[card|5555_5555_5555_4444]] expires soon
credit card [[card|3400.000000.00009]] is blocked
token = [[secret|"9f86d081884c7d659a2feaa0c55ad015a3bf4f1b"]] in the file
token = [[secret|"0b7e1c5f2a9d4433c8e6aa01d2f9bb7c6e5d4f30"]] was found
token: [[secret|c2a81b7e90d34f5566aa0917fe3b8c2d]] do not share
api_key = [[secret|"sk4f9Qz81LmPq7Xw22Rt"]] for tests
api key [[secret|A1b2C3d4E5f6G7h8I9j0]] expired
secret = [[secret|'x8Kd93jfLq02mVbn45Zs']] in config
password: [[secret|tr0ub4dor&3x9Qw]] was leaked
password = [[secret|"hunter2hunter22"]] in the log
passwd [[secret|S3cr3tP4ssw0rd99]] must change
access token [[secret|ya29a0AfH6SMBx3k7Pq2]] is valid
bearer [[secret|eyJhbGciOiJIUzI1NiJ9x7]] in the header
key = [[secret|"5d41402abc4b2a76b9719d911017c592"]] for upload
commit 24be64439e3e49cf46b2d7c90f3602a3d0b907ff fixed the bug
commit 7fd1a60b01f91b314f59955a4e4d4e80d8edf11d was reverted
sha256 9f86d081884c7d659a2feaa0c55ad015a3bf4f1b2b0b822cd15d6c15b0f00a08 of the file
sha1 da39a3ee5e6b4b0d3255bfef95601890afd80709 of nothing
md5 d41d8cd98f00b204e9800998ecf8427e of the archive
checksum 5d41402abc4b2a76b9719d911017c592 matches
uuid 123e4567-e89b-12d3-a456-426614174000 of the row
revision 3f2a9c81d4e7b605 was merged
the file img20231105a7f3b9c2.jpg is missing
version 10.4.2 of the library
version 1.2.3.4.5 was released
released under CC BY-NC 4.0.
Apache License, Version 2.0.
GNU General Public License, version 3.
on 2023-11-05 at 10:45 they met
between 12/05/2021 and 13/06/2022 it rained
isbn 978-3-16-148410-0 is out of print
isbn 0-306-40615-2 on the shelf
order 4785380592391138 was shipped
invoice 2023-000-4711-22 is due
article 1234567890123 in stock
tracking number 9400 1000 0000 0000 0000 00 arrived
the price rose from 1,299.00 to 1,450.50 dollars
about 7 800 000 000 people live there
a population of 1 352 642 280 in 2018
pages 826-955 and 1001-1044
lines 100-200-300 of the table
the score was 3-2 after 120 minutes
section 10.2.3.1 of the manual
figure 3.14159265 is pi
it is 5 + 3 = 8 and 10 + 20 = 30
C++ and A+ are grades and languages
see @ noon or @home in the app
follow @jane_doe on the site
the dot product of two vectors
a red dot at the top of the page
join the dot and the line at noon
10 at 20 and 30 at 40 degrees
built 1995-1996, sold 1998-2001
flight 4711 at gate 23 at 09:15
room 12-34-56 on floor 3
latitude 48.858370 longitude 2.294481
mac 00:1a:2b:3c:4d:5e on the switch
the ratio is 16:9 or 4:3 at 60 Hz
""".strip().splitlines()


def parsed(line: str) -> tuple[str, list[tuple[str, int, int]]]:
    """The text of a line and its spans (kind, begin, end)."""
    text, spans, at = "", [], 0
    for mark in MARK.finditer(line):
        text += line[at : mark.start()]
        spans.append((mark[1], len(text), len(text) + len(mark[2])))
        text += mark[2]
        at = mark.end()
    return text + line[at:], spans
