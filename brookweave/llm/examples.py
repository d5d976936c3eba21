"""Inspected examples: short texts of each class, by which the components of the mixture get their class.

They are ordinary texts of many kinds and of both languages, written for this purpose; none is a row of a table. Every
line of an example votes for the example's class. They are the whole knowledge of what prose is: no rule follows.
"""

PROSE = (
    "The river had risen overnight, and by morning the lower fields were under water. Nobody in the village was surprised, because it had happened every spring since they could remember.",
    "She opened the letter, read it twice, and put it back in the drawer without a word.",
    "When the train finally arrived it was almost empty. We found two seats by the window and slept until the border.",
    "\"Have you seen my keys?\" he asked.\n\"They were on the table an hour ago,\" said his sister, \"but that was before you cleaned it.\"\n\"Then I must have thrown them out.\"",
    "Anna: I thought the meeting was at ten.\nBen: It was, but they moved it to noon because the room was taken.\nAnna: Then we still have time for a coffee.",
    "the shop was closed when we got there so we walked down to the harbour and watched the boats for a while",
    "we waited for an hour, but the doctor never came; in the end my father drove us home, and nobody said a word on the way.",
    "the recipe is older than the house. my grandmother had it from a neighbour, who would not tell her where it came from, and since then it has been passed on in secret.",
    "if the rain stops before noon, we will go to the lake as planned; otherwise the children can stay here and play with the cards that their uncle brought.",
    "did anyone ask the driver why the bus was late? he told me that the road was closed after the storm, so he had to turn back.",
    "THE COUNCIL HAS DECIDED THAT THE BRIDGE WILL BE CLOSED FOR TWO WEEKS. IF YOU LIVE ON THE OTHER SIDE, PLEASE USE THE FERRY UNTIL THE WORK IS DONE.",
    "anh ấy nói rằng con đường đã bị đóng sau cơn bão, nên chúng tôi phải quay lại và chờ đến sáng hôm sau mới đi tiếp được.",
    "nếu chiều nay trời không mưa thì chúng tôi sẽ ra hồ chơi; còn không, bọn trẻ ở nhà đọc sách mà bà đã gửi cho chúng.",
    "HÔM QUA CHÚNG TÔI ĐÃ ĐẾN THĂM CÔ GIÁO CŨ, VÀ CÔ RẤT VUI VÌ MỌI NGƯỜI VẪN CÒN NHỚ ĐẾN CÔ.",
    "in the spring of 1964 my uncle left the farm and took a job in the city where he shared a room with 3 other men from the valley and wrote home every week until the money ran out and he came back",
    "năm 1986 gia đình tôi chuyển vào nam và ở nhờ nhà người bác trong 2 năm trước khi dựng được một căn nhà nhỏ bên sông, nơi các em tôi đã lớn lên",
    "IT WAS LATE WHEN THE LAST GUEST LEFT, AND THE HOSTS WERE TOO TIRED TO CLEAN THE KITCHEN BEFORE THEY WENT TO BED.",
    "I came upon a garden wall\nwhere ivy hid the stone,\nand heard a voice beyond it call\nthe name that was my own.\n\nI answered it, but no one came\nto lead me through the gate,\nand so I learned to love a name\nwho had arrived too late.",
    "How much does it cost to repair a roof? It depends on the size of the house and on how long the damage has been left alone.",
    "In 1998 the company sold 4,200 units for 1.3 million dollars, which was less than half of what it had hoped for at the start of the year.",
    "Please send the form back to us by 15 March 2021, or call 020 7946 0958 if you have any questions about it.",
    "> I am not sure that this is the right way to do it.\n> Could we talk about it on Monday, when the others are\n> back in the office?",
    "We are happy to tell you that your order was shipped this morning 🎉! It should be with you in three days.",
    "A quiet comedy about a baker who inherits a circus and has to learn, in a single winter, how to make people laugh.",
    "# This is why the old account was kept open for so\n# long: the bank could not find the owner, and the law\n# did not allow it to be closed without a notice.",
    "Contrary to what was written in the report, the engine did not fail; it was switched off by mistake.",
    "Bank raises lending rates.",
    "Why the city wants fewer cars in its centre",
    "What I liked most was the ending.",
    "Trời mưa suốt đêm nên sáng hôm sau con đường trước nhà đã ngập nước. Bà tôi nói rằng năm nào cũng thế, cứ đến tháng bảy là phải kê đồ lên cao.",
    "Anh ấy mở cửa sổ ra và nhìn xuống phố, nơi những người bán hàng đang dọn gánh để về nhà.",
    "Tôi đã gọi cho cửa hàng hai lần nhưng không ai trả lời, vì vậy tôi sẽ đến đó vào ngày mai.",
    "- Sao hôm nay con về muộn thế?\n- Dạ, xe buýt bị hỏng nên con phải đi bộ về, mẹ ạ.",
    "Theo báo cáo năm 2019, công ty đã bán được 4.200 sản phẩm với giá 12,5 triệu đồng, ít hơn một nửa so với kế hoạch.",
    "Một bộ phim nhẹ nhàng về người thợ may già, người đã giữ lại lá thư của vợ trong suốt ba mươi năm.",
    "Bạn có biết vì sao lá cây chuyển sang màu vàng vào mùa thu không?",
    "Em ơi mùa xuân đến rồi đó\ngió đã về trên những cánh đồng\nvà trong vườn hoa vừa hé nở\ncó nhớ ngày em bước sang sông.",
    "ngay mai chung toi se den tham ong ba va o lai do cho den het tuan",
    "Trong khi chờ máy bay, họ ngồi nói chuyện về chuyến đi và về những điều mà họ chưa kịp làm.",
    "To open the box, turn the small handle to the left until you hear a click, and then lift the lid.",
    "The command `git status` shows which files have changed since the last commit, and it is the first thing I run in the morning.",
)

LIST = (
    "- apples\n- bread\n- olive oil\n- two lemons\n- a pound of rice",
    "* red wine\n* white wine\n* sparkling water\n* fresh mint",
    "• Marketing\n• Human resources\n• Research and development\n• Customer support\n• Legal",
    "1. Mix the flour\n2. Add butter\n3. Whisk eggs\n4. Bake 40 minutes\n5. Cool",
    "1) Paris\n2) London\n3) Madrid\n4) Rome\n5) Vienna\n6) Prague",
    "a) a valid passport;\nb) two photographs;\nc) proof of address;\nd) the signed form;",
    "- [ ] buy stamps\n- [x] water the plants\n- [ ] call the dentist\n- [x] book flights",
    "Home\nAbout us\nProducts\nContact\nPrivacy policy\nTerms of use",
    "John Smith\nMaria Garcia\nWei Chen\nAmina Yusuf\nPeter Novak",
    "hammer\nnails\nscrewdriver\ntape measure\nsandpaper\nwood glue",
    "REF-1023\nREF-1024\nREF-1031\nREF-1077\nREF-2001",
    "the old bridge\nthe market square\nthe north tower\nthe city library\na small chapel",
    "apples, pears, plums, cherries, quinces, grapes, oranges, lemons, figs, dates",
    "Tags: travel, food, photography, budget, europe, summer, beach, family, camping, tips",
    "Berlin; Hamburg; Munich; Cologne; Frankfurt; Stuttgart; Leipzig; Dresden",
    "Oslo / Bergen / Stavanger / Trondheim / Tromso / Drammen",
    "- áo sơ mi\n- quần dài\n- giày da\n- khăn quàng\n- mũ len",
    "• phòng kế toán\n• phòng nhân sự\n• ban giám đốc\n• tổ bảo vệ",
    "1. gạo nếp\n2. đậu xanh\n3. thịt lợn\n4. lá dong\n5. hạt tiêu",
    "Trang chủ\nGiới thiệu\nSản phẩm\nLiên hệ\nTuyển dụng",
    "Hà Nội, Hải Phòng, Đà Nẵng, Huế, Cần Thơ, Nha Trang, Vũng Tàu",
    "a) hộ chiếu;\nb) hai ảnh thẻ;\nc) đơn xin việc;\nd) bằng tốt nghiệp;",
    "cheap flights cheap hotels car rental travel insurance airport transfer city tours",
)

TABLE = (
    "| name | age | city |\n| --- | --- | --- |\n| Lee | 34 | Seoul |\n| Diaz | 29 | Lima |\n| Okoro |  | Lagos |",
    "name,age,city,joined\nLee,34,Seoul,2019-04-01\nDiaz,29,Lima,2020-11-15\nOkoro,41,Lagos,2018-07-30",
    "id\tprice\tqty\tdate\n17\t4.50\t3\t2021-02-03\n18\t12.00\t1\t2021-02-03\n19\t0.99\t40\t2021-02-04",
    "17;4,50;3;2021-02-03;EUR\n18;12,00;;2021-02-03;USD\n19;0,99;40;n/a;EUR\n20;;7;2021-02-05;GBP",
    "\"17\",\"4.50\",\"\",\"2021-02-03\",\"Lima\"\n\"18\",\"12.00\",\"1\",\"2021-02-03\",\"\"\n\"19\",\"0.99\",\"40\",\"2021-02-04\",\"Rome\"",
    "<tr><td>17</td><td>4.50</td><td>Lima</td></tr>\n<tr><td>18</td><td></td><td>Rome</td></tr>\n<tr><th>id</th><th>price</th><th>city</th></tr>",
    "City          Population     Area\nLima          9751717        2672\nRome          2872800        1285\nOslo          693494         480",
    "{\"id\": 17, \"price\": 4.5, \"city\": \"Lima\"}\n{\"id\": 18, \"price\": null, \"city\": \"Rome\"}\n{\"id\": 19, \"city\": \"\"}",
    "Rent: 1,250.00\nElectricity: 84.20\nWater: 31.75\nInternet: 39.99\nTotal: 1,405.94",
    "height = 182 cm\nweight = 79.5 kg\npulse = 61\ntemperature = 36.8",
    "Tiền nhà: 3.500.000\nTiền điện: 412.000\nTiền nước: 96.000\nTổng cộng: 4.008.000",
    "| tên | tuổi | quê |\n| Lan | 31 | Huế |\n| Minh |  | Vinh |\n| Hoa | 27 | Hà Nội |",
    "Q1 12.4 13.1 15.0 9.8\nQ2 11.7 12.9 14.2 10.3\nQ3 10.1 11.8 13.7 9.9",
    "2020-01-01    17.2    1013.2    0.0\n2020-01-02    16.8    1011.9    2.4\n2020-01-03    18.1    1009.5    0.3",
    "FirstName: Ana\nLastName: Silva\nBirthDate: 1984-05-17\nPhone: 555 0134\nZip: 04109",
)

JUNK = (
    "Jun 14 03:12:44 host7 sshd[4312]: Accepted publickey 10.0.3.17 port 52144 ssh2\nJun 14 03:12:45 host7 systemd[1]: Started session-118.scope\nJun 14 03:12:51 host7 kernel: eth0 link up 1000Mbps",
    "2019-08-02 11:20:31,114 [main] INFO o.s.b.StartupLogger id=77 took=0.312s\n2019-08-02 11:20:31,998 [pool-3] ERROR c.e.Worker code=504 retry=3 host=10.2.0.9",
    "level=info msg=started pid=4312 port=8080 env=prod\nlevel=warn msg=retry attempt=3 delay=250ms host=db02\nlevel=error msg=timeout code=504",
    "Exception in thread \"main\" java.lang.NullPointerException\n    at com.example.app.Loader.read(Loader.java:114)\n    at com.example.app.Main.run(Main.java:37)\n    at java.base/java.lang.Thread.run(Thread.java:829)",
    "for (int i = 0; i < n; i++) { sum += a[i] * b[i]; }\nif (x == null) { return -1; }\nmap.put(key, value);",
    "4d 5a 90 00 03 00 00 00 04 00 00 00 ff ff 00 00\nb8 00 00 00 00 00 00 00 40 00 00 00 00 00 00 00",
    "0x7ffe12ab 0x00000010 0xdeadbeef 0x0000002a 0xcafebabe 0x00001000",
    "iVBORw0KGgoAAAANSUhEUgAAAAUAAAAFCAYAAACNbyblAAAAHElEQVQI12P4Jx8c3wEMLyD7Rxk0a9QvQnB1eXZyAk9TQWLzPqhKtM",
    "d41d8cd98f00b204e9800998ecf8427e\n9e107d9d372bb6826bd81d3542a419d6\ne4d909c290d0fb1ca068ffaddf22cbd0",
    "asdkjfh qwlekjrh zxmcnvb alskdjf qpwoeiru zmxncbv sldkfjg\nkjshdf lkjqwe mnbzxc rtyughj bvncmx",
    "xkcd vbnm qwrt plkj hgfd szxc bnmv trwq jklp dfgh cvbn",
    "!!! ### $$$ %%% @@@ ^^^ &&& *** ((( ))) ___ +++",
    "@#$%^&*()_+{}|:<>?~`-=[]\\;',./ %$#@!^&*",
    "=====================================\n-------------------------------------",
    "🔥🔥🔥 💯💯 ✅✅✅ ❌ ➡➡ ⭐⭐⭐⭐ 🎉🎉🎉",
    "■□■□■□ ▒▒▒▒▒ ░░░░ ►►► ◄◄ ●●●● ★★★",
    "buy now buy now buy now buy now buy now buy now buy now buy now buy now buy now",
    "test test test test test test test test test test test test test test",
    "?????? ???? ??? ?????? ??? ?????? ???? ???????",
    "��� �� ����� ��� �� ���� ������� ��",
    "CafÃ© ouvert jusquâ€™Ã  23h, dÃ©jÃ  rÃ©servÃ© par lâ€™Ã©quipe Ã  cÃ´tÃ©",
    "TrÆ°á»ng ÄÃ£ gá»­i thÃ´ng bÃ¡o cho háº¿t cÃ¡c phá»¥ huynh vÃ o tuáº§n trÆ°á»›c, vÃ¬ lá»‹ch há»c thay Ä‘á»•i",
    "...... ...... ...... ...... ......",
    "%PDF-1.4 %âãÏÓ 6 0 obj <</Linearized 1/L 21212/O 8/E 16923/N 1/T 21046/H [ 496 156]>> endobj",
    "NaN NaN undefined null null [object Object] undefined NaN",
)

EXAMPLES = tuple((kind, text) for kind, texts in (("prose", PROSE), ("list", LIST), ("table", TABLE), ("junk", JUNK)) for text in texts)
