"""Inspected examples of each kind of text; the mixture's components take their kinds from them.

Each style is seen in posts of the test tables and is given here in a few texts of its own kind.
"""

EXAMPLES: dict[str, dict[str, list[str]]] = {
    "prose": {
        "sentence": ["Thanks, that was it.", "No luck so far, sorry.", "Good point, I will try that on Monday.", "Same here.", "Any news on this?", "Yes, please see my post above.", "That did not change anything for me.", "Could you send the file? http://pics.invalid/3.png"],
        "careless": ["i have the same question", "same here", "any news on this", "no luck so far, sorry", "could you post the log", "it works now, many thanks to all of you", "good point, i will try that on monday"],
        "brief": ["same here", "me too", "no idea", "same problem here", "works now"],
        "post": [
            "It turned out that the rows were read twice, so I made the mask again last night. To be honest, the panel is not the problem, because the names were sorted differently.",
            "Has anyone seen such a bright edge in the second slide when the lamp was old? My guess is that the header had changed; if so, look at the first lines and then ask the person who stained it.\n\nThere is a strange region next to every core, which is why I asked.",
            "What worries me more is the dark stripe that came back on another scanner, since nothing else had changed. You can keep the old version, but only if both tables have the same number of rows.",
        ],
        "wrapped": [
            "The whole team tried the new matrix this\nmorning and the groups split in two. Set k=9,\nres=0.58 and min_cells=46, then run it by\nhand. Let me add that the plot came out\nempty in 49 of 80 runs, which may be chance,\nor may not.",
            "In my experience, you should start with a small\ncrop before you blame the channel. When my student\ncompared the cores on Thursday, the curve went\nflat and we had to begin again with fresh\nantibodies.",
        ],
        "settings": ["The path is /data/tovmos/run_44.csv on the share. Steps: (1) read the header line by line, (2) compare with the control, (3) ask the person who did it. Set k=7, res=0.6 and min_cells=51, then run it with a lower threshold.", "Between 15:05 and 16:40 we scanned 34 slides at 20x (0.377 um/px), 14 fields each, and lost 40 of them. Set k=37, res=0.35 and min_cells=19, then run it with the default settings."],
        "german": ["Vielen Dank für die Antwort, damit läuft es wieder. Ich glaube, dass das Gewebe gefaltet ist, aber im Protokoll steht nichts.", "Gestern haben wir die Maske noch einmal geprüft, und der Rand ist sauberer. Hat jemand von euch das schon gesehen?"],
        "french": ["Merci pour la réponse, cela marche de nouveau avec 38 champs. Je pense que le tissu est plié, mais le journal ne dit rien.", "Hier, nous avons comparé les lames et les chiffres sont corrects. Est-ce que quelqu'un a déjà vu cette erreur ?"],
        "spanish": ["Gracias por la paciencia, con 55 campos vamos mejor. ¿alguien ha visto este error cuando la lámpara es vieja?", "Ayer revisamos la máscara y el borde quedó más limpio. Creo que el tejido está doblado, pero no estoy seguro."],
        "offer": [
            "Do not miss this offer, because it ends on Friday and it will not come back. Visit our shop today and save 38 percent on every lamp you order before Thursday.",
            "Visit 0ur st0re t0day and save 25 percent 0n every b0ttle y0u 0rder bef0re M0nday. D0 n0t miss this deal, because it ends s00n and it will n0t c0me back!!",
            "CLICK HERE NOW!!! You will not believe how easy it is to earn 500 coins in one week. http://shop.invalid/77",
        ],
        "story": ["“Because the old bridge flooded Karholm moved 59 bell founders uphill and Mossten kept their oil at the quarry Nobody from Mossten may carry smoked eels past the granary unless Karholm has counted 12 ink cakes first", "that did not change anything for me\n\nNobody from Yornav may carry wool\nblankets past the mill pond unless Wexdul has counted 25 ink cakes first.\nOld ledgers mention", "Every third year a council locks the gates, while Nordim feeds the birds only when winter comes. Tovkar, whose aunt sang near the harbour, owed 59 sacks of barley to the dyers from Belmos."],
        "unpunctuated": ["i think it is the lamp but we have not looked at the log yet and my student says that it was fine before the update so maybe somebody could check it when they are back"],
    },
    "list": {
        "bullets": ["- timer\n- oil, new\n- cover slips (12)\n- lens paper\n- spare lamp\n- ethanol\n- wash buffer, old", "* hard drive\n- cable\n* sample box, spare\n* tweezers (31)\n- xylene\n* ethanol, cold room", "My list so far:\n* spare lamp\n* primary antibody (25)\n* sample box\n* timer\n* mounting medium\n* pipette tips"],
        "numbered": ["1. wash buffer\n2. oil\n3. objective 20x (57)\n4. cover slips\n5. hard drive\n6. tweezers (3)\n7. pipette tips\n8. citrate buffer", "This is what we have:\n1. timer, cold room\n2. primary antibody, old\n3. lamp\n4. sample box\n5. cable\n6. blades (49)"],
        "lines": ["filter cube (22)\nsample box\ntyramide kit\noil (37)\noil\ncontrol slides\ncover slips (47)\nhard drive\nwash buffer", "Inventory\nsample box, new\noil, spare\nxylene (8)\nlens paper, new\ntweezers\nfilter cube (11)\ntimer"],
        "commas": ["objective 20x (31), primary antibody (27), tyramide kit, cold room, hard drive (9), lens paper, timer, spare lamp, tweezers (54), cover slips, new, pipette tips", "oil, timer, lens paper, new, cable, hard drive (7), wash buffer, ethanol, spare lamp, sample box, cable"],
        "notes": ["CD45: weak\nCD68: repeat\nCD56: weak\nPD_L1: ok\nCD31: weak\nCD34: 1:600\nPanCK: ok\nCD20: repeat", "Needed for the next run.\nCD14: repeat\nCD45: weak\nSMA: clone Belmos\nCD34: clone Tovral\nKi67: ok\nCD20: 1:400"],
    },
    "table": {
        "box": ["+------------+------------+------------+\n|         q50|         day|        mean|\n|         C03|         C04|    Vimentin|\n|         C04|      Tovral|         C15|\n|        PD_1|        CD16|       SOX10|\n+------------+------------+------------+"],
        "pipes": ["| q50 | mean | flag |\n| --- | --- | --- |\n| PanCK | C03 | NA |\n| 52.53 | Deljunulm | C07 |\n| CD68 | 4015 | C04 |\n| NA | 89.31 | NA |", "Results\n| area | sd | marker | flag |\n| --- | --- | --- | --- |\n| NA | 29.83 | NA | GZMB |\n| 55 | 24.97 | C02 | NA |"],
        "tabs": ["area\tflag\tsd\tmean\n84.56\tNA\tC01\tBeldro\n1586\t1751\tC13\tNA\nCD11c\t2768\t31.30\tC19\nNA\t44.38\t6555\t62.97", "See table.\nn\tarea\tday\n5807\tCD68\t51.46\nC20\tC05\t7514\n32.44\t57.92\tNA\nNA\tC11\t82.77"],
        "semicolons": ["sd;marker;area;flag\nNA;C11;HLA_DR;C18\n35.80;C03;C04;NA\n73.83;CD68;5415;C12\nCD79a;NA;CD68;Wextov\n2972;C01;7999;C18"],
        "csv": ["sd,flag,mean,sample,day\nNA,C04,HLA_DR,23.51,9525\n57.47,67.70,10.32,Ralmos,CD14\nCD3,PD_1,CD34,68.94,24.59\nC18,Holba,GZMB,C17,PD_1"],
        "columns": ["mean        q50         sample      flag\n726         NA          CD163       C12\nNA          C03         Quindel     2976\nNA          9029        6299        Mosver\n6759        C20         4667        C06", "Numbers from the last run:\ncluster     mean        sd\nNA          NA          Delnav\n2821        Quinfen     CD16\nCD79a       Wexmi       17.42"],
        "numbers": ["12;7.5;640;3\n88;1.25;17;940\n5;66;713;2.5\n410;9;8;71\n6;15;230;44", "0.5,17,92.1\n3,440,8.25\n61,7,19\n2.75,31,508\n90,4,12.5", "n\tarea\tmean\n4\t57.2\t913\n18\t6\t44.1\n730\t2.9\t85"],
        "html": ["<table><tr><td>flag</td><td>n</td><td>marker</td></tr><tr><td>C18</td><td>2453</td><td>SMA</td></tr><tr><td>6319</td><td>NA</td><td>40.99</td></tr><tr><td>61.82</td><td>CD34</td><td>C05</td></tr></table>"],
    },
    "junk": {
        "symbols": [".?}=:;%0 <]]38]6<>}9 }{$}6663~6[~6147{;/%4^*4{~/6^<? 93*:{}_|&<1=*>*>{ 9_5};  _{./%:&8}?;2{<0]] *9$6%0", "{..~*]8/[68?.;-=/5=%*]._/+75[5@+3$^[__<+#@2@<8-}8-_952}+$0&3854$3"],
        "encoded": ["BY3HWsHYthKXjkpmo/OvCZjqT7eqc0XnbJ0BPFVRaFdy9/DZZMzJXd6Nur4t5CP6xklvnLRHc0cq\nxrUtF+aULpcwOM8flIQFR5yCpXsEP5ugXdQx8FsLDA==", "GKhPjY8BGlo+tUu7BY9muZXkvlPzyOuO2iWhpuXYgoliUO6s+JD1qy6F+3rFHwzwu6qSpJx7YKA="],
        "dump": ["00000000  1d 70 17 d3 78 a5 b7 6a aa bd df 96 bf 12 16 43\n00000010  1e b0 65 3e 09 5f a2 3b f9 10 45 2b 81 4c 22 0a", "00000000  25 81 f5 c0 10 36 fd f2 6b a0 62 74 02 8a 19 f2\n00000010  27 01 ac af 48 f7 84 4e 5c 9f 69 39 b1 28 5c 52\n00000020  93 ad 84 fd 5e 21 6b 2f d1 d7 ec ee 38 76 a2 1d"],
        "rule": ["_" * 70, "=" * 60, "." * 60],
        "repeated": ["bump " * 30, "test test test test test test test test test test test test test", "lol " * 20],
        "stretched": ["a" * 80, "ha" * 60, "o" * 150, "he" * 30, "a" * 200],
        "signs": ["🔬" * 60, "♥" * 40, "★☆" * 30],
        "sorted": ["a a after again all and and and as asked background because before blurry but came cell channel close compare did edge fields first group guess had i if in is it", "13 4 a a about after and are be been bright checked close cores differently; edge fields guess had i if is it just labels mask me my no not of on once"],
        "log": ["corlim:34 ERR 0xd6d1 sten/peltri.c core\nbasten:172 ERR 0xfdb9 kardel/ostnav.c sig11\ncordel:416 ERR 0xaaf0 corsten/kargri.c eof\nyormi:332 ERR 0x8b1e tovmos/versten.c nil"],
        "damaged": ["Je pen§e que le tis¶u §st pliÃ\x83Â¶Ã\x82Â©, §aÃs �¤ joÃ¤nal n§ d§¤ rien. Est¤ceÃqu§Âquelqu'�¶ ¤ dÃ\x83§\x83Ã\x82Â©jÃ\x83Â\x83Ã\x82ÂÃÃvÂ �ne bande par§ill§�quand ¶a lampÃ esÂ¤¶ieil�¤ ?"],
        "scrambled": ["osbdmyoe arssptui vrene irubelt het ez-dlsac a,uvsle os ti si rhad ot yas wyh the riespt si so rrluyb it ndeurt otu ttha the hcace swa leats", "fi hte chace swa atle,s enth hte temdsoho rcesos lilw olok suntobbr on trtema tahw uyo ,od and rwda het iltonue aaign"],
        "salad": ["mounting medium surprising CD138 stripe CD163 CD66b CD31 TIM3 primary antibody objective 20x CD68 mounting medium promising CD79a PD_L1 pipette tips sample box uneven PanCK CD4", "cheap lamp slide CD57 noisy buffer blurry cable tiny border CD14 odd batch CD3 bright panel online kit CD8 dye harmless pattern tips SMA"],
    },
}
