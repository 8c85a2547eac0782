"""Hand-labelled lines: <kind|value> marks a span that the patterns miss, and all else is none."""

LINES = """
please write to <email|karin.vogt (at) nordwind.de> before the meeting starts
my new address is <email|tom [at] riverbank [dot] org>, the old one is gone
contact <email|l.moreau @ atelier.fr> for the keys of the house
send it to <email|office@ harbour.co.uk> and wait for an answer
or <email|sales(at)brightwood.com>; they answer within two days
<email|anna_k [at] mail.example.net> has the list of all guests
the mail went to <email|jo@pinehill[.]com> but never came back
try <email|help (at) kiosk (dot) io> if the door stays shut
he uses <email|peter77 [at] webpost.at> for all of his orders
the server behind <ip|10[.]0[.]12[.]7> was shut down last night
traffic came from <ip|185[.]220[.]101[.]4> and from nowhere else
route it over <ip|172 . 16 . 254 . 3> until the line is back
he logged in from <ip|192.168.7[.]23> at noon and left again
blocked: <ip|45[.]33[.]32[.]156>, seen many times in the log
she paid with <card|4111.1111.1111.1111> and got the bill by post
the number <card|5500/0000/0000/0004> was read out on the phone
card <card|3782.822463.10005> is blocked since the first of May
charge <card|4012  8888  8888  1881> for the two extra nights
both <card|4111111111111111> <card|5555555555554444> were found in the file
the cards <card|4012888888881881> <card|4111111111111111> belong to them
call me on <phone|(212) 555-0143> after the show has ended
the office has <phone|415-555-0198>, ask there for the manager
reach them at <phone|0044 20 7946 0958> from outside the country
new number: <phone|020.555.0177>, please tell the others too
dial <phone|1 (303) 555-0112> and then wait for the tone
her mobile is <phone|+44/20/7946/0321>, it is off at night
ring <phone|+ 49 30 5550 1234> when you have found the place
write or call <phone|(646)555-0109>; both work on weekdays
the shop <phone|1-800-555-0199> is open from nine to five
the report of 2024-03-17 was changed on 2024-04-02 12:30:45
version 3.12.4 came after 3.11.9 and before 3.13.0 of the tool
they sold 1,234,567.89 worth of goods in 365 days, up 12.5% on 2019
see pages 112-118 and 204-219 of volume 12 for the whole story
ISBN 978-3-16-148410-0 is out of print since the year 1999
meet them (at) noon near gate 12 or call again in 20 minutes
follow @riverbank and @nordwind77 for the news of the day
the order 20240317001 has 12 parts of 40 x 60 x 80 and weighs 1200
the number 4111.1111.1111.1112 is wrong, as its check digit shows
set size = 4096, rate = 0.001 and seed = 1234567890 for the run
between 10:15 and 11:45 the price went from 99.95 to 101.20
the year 1848, the 24 hours, room 1204, and 3 of 4 who came
points (12, 45, 78, 90) and [3, 5, 8] lie on the same line
token = "7702344ead31d5951ffa62ab" must not be shared with others
article 12.3.4 of the law from 17.03.2024 holds for all 27 states
""".strip().splitlines()
