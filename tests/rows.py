"""Fixed input rows of the golden cases, as text lines."""

# words
WORD_LINES = """\
hello scala
hello java
hello spark
hello python
""".splitlines()

# id (with literal quotes), time in ms, level
SENSOR_LINES = """\
'sensor_1',1600262289186,49
'sensor_0',1600262291199,42
'sensor_1',1600262293199,47
'sensor_2',1600262295200,43
'sensor_2',1600262297200,43
'sensor_0',1600262299201,80
'sensor_2',1600262301202,48
'sensor_0',1600262303202,100
'sensor_2',1600262305202,40
'sensor_2',1600262307203,42
'sensor_0',1600262309204,43
'sensor_0',1600262311204,70
'sensor_0',1600262313204,46
'sensor_0',1600262315205,41
'sensor_2',1600262317205,43
""".splitlines()

# order, event type, transaction, time in s
ORDER_LINES = """\
34729,create,,1558430842
34730,create,,1558430843
34729,pay,sd76f87d6,1558430844
34730,pay,3hu3k2432,1558430845
34731,create,,1558430846
34731,pay,35jue34we,1559430849
34732,create,,1558430852
34733,create,,1558430855
34734,create,,1558430859
34732,pay,32h3h4b4t,1558430861
34735,create,,1558430862
34734,pay,435kjb45d,1558430863
34733,pay,766lk5nk4,1558430864
34736,create,,1558430866
34737,create,,1558430868
34735,pay,5k432k4n,1558430869
34738,create,,1558430871
34739,create,,1558430874
34736,pay,435kjb45s,1558430875
34740,create,,1558430877
34741,create,,1558430882
34742,create,,1558430884
34743,create,,1558430885
34744,create,,1558430886
34745,create,,1558430889
34746,create,,1558430892
34747,create,,1558430893
34748,create,,1558430895
34746,pay,3243hr9h9,1558430895
34738,pay,43jhin3k4,1558430896
34745,pay,8xz09ddsaf,1558430896
34741,pay,88df0wn92,1558430896
34749,create,,1558430899
34747,pay,329d09f9f,1558430893
34743,pay,3hefw8jf,1558430900
34750,create,,1558430901
34737,pay,324jnd45s,1558430902
34751,create,,1558430902
34744,pay,499dfano2,1558430903
34752,create,,1558430905
34742,pay,435kjb4432,1558430906
34753,create,,1558430906
34739,pay,98x0f8asd,1558430907
34754,create,,1558430908
34755,create,,1558430911
34740,pay,392094j32,1558430913
34756,create,,1558430913
34753,pay,8c6vs8dd,1558430913
34757,create,,1558430915
34749,pay,324n0239,1558430916
34755,pay,8x0zvy8w3,1558430918
34758,create,,1558430921
34759,create,,1558430922
34752,pay,rnp435rk,1558430925
34760,create,,1558430926
34761,create,,1558430927
34762,create,,1558430933
34748,pay,809saf0ff,1558430934
34763,create,,1558430936
34764,create,,1558430938
34765,create,,1558430940
34751,pay,24309dsf,1558430941
34750,pay,sad90df3,1558430941
34761,pay,902dsqw45,1558430943
34766,create,,1558430944
34767,create,,1558430949
34768,pay,88snrn932,1558430950
34759,pay,9203kmfn,1558430950
34754,pay,3245nbo7,1558430950
34758,pay,32499fd9w,1558430950
34760,pay,390mf2398,1558430960
34757,pay,d8938034,1558430962
34762,pay,84309dw31r,1558430983
34763,pay,sddf9809ew,1558431068
34764,pay,832jksmd9,1558431079
34765,pay,m23sare32e,1558431082
34766,pay,92nr903msa,1558431095
34756,pay,9032n4fd2,1558431951
34767,pay,sdafen9932,1558432021
""".splitlines()

# user, ad, province, city, time in s
AD_CLICK_LINES = """\
543462,1715,beijing,beijing,1511658000
662867,2244074,guangdong,guangzhou,1511658060
561558,3611281,guangdong,shenzhen,1511658120
894923,1715,beijing,beijing,1511658180
834377,2244074,shanghai,shanghai,1511658240
625915,3611281,guangdong,zhuhai,1511658300
578814,1715,guangdong,shenzhen,1511658330
873335,1256540,shanghai,shanghai,1511658540
429984,2244074,guangdong,shenzhen,1511658600
937166,1715,beijing,beijing,1511661601
937166,1715,beijing,beijing,1511661602
937166,1715,beijing,beijing,1511661603
937166,1715,beijing,beijing,1511661604
937166,1715,beijing,beijing,1511661605
937166,1715,beijing,beijing,1511661606
937166,1715,beijing,beijing,1511661607
937166,1715,beijing,beijing,1511661608
161501,36156,jiangsu,nanjing,1511661608
937166,1715,beijing,beijing,1511661609
937166,1715,beijing,beijing,1511661610
937166,1715,beijing,beijing,1511661611
937166,1715,beijing,beijing,1511661612
937166,1715,beijing,beijing,1511661613
937166,1715,beijing,beijing,1511661614
937166,1715,beijing,beijing,1511661615
937166,1715,beijing,beijing,1511661616
937166,1715,beijing,beijing,1511661617
937166,1715,beijing,beijing,1511661618
2315,36156,zhejiang,hangzhou,1511661618
10236,5614,henan,zhengzhou,1511661619
937166,1715,beijing,beijing,1511661619
937166,1715,beijing,beijing,1511661620
937166,1715,beijing,beijing,1511661621
937166,1715,beijing,beijing,1511661622
937166,1715,beijing,beijing,1511661623
937166,1715,beijing,beijing,1511661624
937166,1715,beijing,beijing,1511661625
937166,1715,beijing,beijing,1511661626
937166,1715,beijing,beijing,1511661627
937166,1715,beijing,beijing,1511661628
937166,1715,beijing,beijing,1511661629
937166,1715,beijing,beijing,1511661630
937166,1715,beijing,beijing,1511661631
937166,1715,beijing,beijing,1511661632
937166,1715,beijing,beijing,1511661633
937166,1715,beijing,beijing,1511661634
937166,1715,beijing,beijing,1511661635
937166,1715,beijing,beijing,1511661636
937166,1715,beijing,beijing,1511661637
937166,1715,beijing,beijing,1511661638
937166,1715,beijing,beijing,1511661639
937166,1715,beijing,beijing,1511661640
2315,36237,zhejiang,hangzhou,1511661641
10236,2914,henan,zhengzhou,1511661641
2315,7156,zhejiang,hangzhou,1511661641
10236,5389,hebei,shijiazhuang,1511661641
937166,1715,beijing,beijing,1511661641
937166,1715,beijing,beijing,1511661642
937166,1715,beijing,beijing,1511661643
937166,1715,beijing,beijing,1511661644
937166,1715,beijing,beijing,1511661645
937166,1715,beijing,beijing,1511661646
937166,1715,beijing,beijing,1511661647
937166,1715,beijing,beijing,1511661648
937166,1715,beijing,beijing,1511661649
937166,1715,beijing,beijing,1511661650
937166,1715,beijing,beijing,1511661651
937166,1715,beijing,beijing,1511661652
161501,36156,jiangsu,nanjing,1511661652
937166,1715,beijing,beijing,1511661653
937166,1715,beijing,beijing,1511661654
161501,36156,jiangsu,nanjing,1511661654
161501,36156,jiangsu,nanjing,1511661655
937166,1715,beijing,beijing,1511661655
937166,1715,beijing,beijing,1511661656
937166,1715,beijing,beijing,1511661657
937166,1715,beijing,beijing,1511661658
937166,1715,beijing,beijing,1511661659
937166,1715,beijing,beijing,1511661660
937166,1715,beijing,beijing,1511661661
937166,1715,beijing,beijing,1511661662
937166,1715,beijing,beijing,1511661663
937166,1715,beijing,beijing,1511661664
937166,1715,beijing,beijing,1511661665
937166,1715,beijing,beijing,1511661666
937166,1715,beijing,beijing,1511661667
937166,1715,beijing,beijing,1511661668
937166,1715,beijing,beijing,1511661669
937166,1715,beijing,beijing,1511661670
937166,1715,beijing,beijing,1511661671
937166,1715,beijing,beijing,1511661672
937166,1715,beijing,beijing,1511661673
937166,1715,beijing,beijing,1511661674
937166,1715,beijing,beijing,1511661675
937166,1715,beijing,beijing,1511661676
937166,1715,beijing,beijing,1511661677
937166,1715,beijing,beijing,1511661678
937166,1715,beijing,beijing,1511661679
937166,1715,beijing,beijing,1511661680
937166,1715,beijing,beijing,1511661681
937166,1715,beijing,beijing,1511661682
937166,1715,beijing,beijing,1511661683
937166,1715,beijing,beijing,1511661684
937166,1715,beijing,beijing,1511661685
937166,1715,beijing,beijing,1511661686
937166,1715,beijing,beijing,1511661687
937166,1715,beijing,beijing,1511661688
937166,1715,beijing,beijing,1511661689
937166,1715,beijing,beijing,1511661690
937166,1715,beijing,beijing,1511661691
937166,1715,beijing,beijing,1511661692
2315,36237,zhejiang,hangzhou,1511661692
10236,2914,henan,zhengzhou,1511661693
2315,7156,zhejiang,hangzhou,1511661693
937166,1715,beijing,beijing,1511661693
937166,1715,beijing,beijing,1511661694
937166,1715,beijing,beijing,1511661695
937166,1715,beijing,beijing,1511661696
937166,1715,beijing,beijing,1511661697
937166,1715,beijing,beijing,1511661698
937166,1715,beijing,beijing,1511661699
937166,1715,beijing,beijing,1511661700
937166,1715,beijing,beijing,1511661701
937166,1715,beijing,beijing,1511661702
937166,1715,beijing,beijing,1511661703
937166,1715,beijing,beijing,1511661704
937166,1715,beijing,beijing,1511661705
937166,1715,beijing,beijing,1511661706
937166,1715,beijing,beijing,1511661707
937166,1715,beijing,beijing,1511661708
937166,1715,beijing,beijing,1511661709
937166,1715,beijing,beijing,1511661710
937166,1715,beijing,beijing,1511661711
937166,1715,beijing,beijing,1511661712
937166,1715,beijing,beijing,1511661713
937166,1715,beijing,beijing,1511661714
937166,1715,beijing,beijing,1511661715
937166,1715,beijing,beijing,1511661716
937166,1715,beijing,beijing,1511661717
937166,1715,beijing,beijing,1511661718
937166,1715,beijing,beijing,1511661719
937166,1715,beijing,beijing,1511661710
937166,1715,beijing,beijing,1511661711
""".splitlines()
