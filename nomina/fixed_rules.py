"""Shipped priority rules for Russian/English goods and services names.

Fixed values: results depend on every pattern, category, priority and on the
order of the entries (equal priorities resolve by position). Keep them as text,
in this order.

Entry: (pattern, category, priority[, apply_if[, exclude_if]]).
"""

# Fixed values, not to be edited: they must equal the published rule set.
SHIPPED_RULES = [
    ("(?i)сбор(?!ник).*(?!мусор|тбо|отход)", "Услуги → Сборы и комиссии", 200),
    ("(?i)сервисн.*сбор", "Услуги → Сборы и комиссии", 200),
    ("(?i)комисс.*вознагр|агентск|брокерск|терминальн", "Услуги → Комиссионные и агентские", 200),
    ("(?i)билет(?!.*парковк)", "Услуги → Транспорт → Билеты", 200),
    ("(?i)(авиа|авиабилет|перелет|рейс)", "Услуги → Транспорт → Авиабилеты", 200),
    ("(?i)(маршрут|проездной|трансфер|транспортировк)", "Услуги → Транспорт → Прочие перевозки", 200),
    ("(?i)хранени(е|я)", "Услуги → Складские услуги", 57),
    ("(?i)контейнер(а|ов?)", "Услуги → Транспорт → Грузоперевозки", 56),
    ("(?i)(автомобиль|a/м|тс|vin)", "Авто → Транспортные средства", 55),
    ("(?i)(geely|toyota|hyundai|kia|changan|rav4|camry|corolla)", "Авто → Транспортные средства", 55),
    ("(?i)(крем|гель|спрей|лосьон|тоник|паста)", "Косметика", 54, [], ["гель.*душ"]),
    ("(?i)(аренд.*оборудовани|оборудовани.*аренд)", "Услуги → Аренда оборудования", 54),
    ("(?i)(проживан|размещен|гостиниц|отел|hotel)", "Услуги → Проживание и гостиницы", 200),
    ("(?i)(almaty|astana|aktau|atyrau|shymkent|karaganda).*hotel", "Услуги → Проживание и гостиницы", 200),
    ("(?i)^услуг[аи]?$", "Услуги → Прочие услуги", 200),
    ("(?i)услуг.*(по|за|на)", "Услуги → Прочие услуги", 200),
    ("(?i)(emd|fee|charge|surcharge)", "Услуги → Сборы и надбавки", 200),
    ("(?i)(операци|платеж|оплат|возврат|возмещен)", "Услуги → Финансовые операции", 200),
    ("(?i)аренд.*(автомобил|машин|авто|транспорт|легков)", "Услуги → Транспорт → Аренда автомобилей", 190),
    ("(?i)(топливо|бензин|дизель|гсм)", "Продукты → Топливо", 56),
    ("(?i)аренд.*(грузов|камаз|газель|фура|контейнер)", "Услуги → Транспорт → Аренда грузового транспорта", 190),
    ("(?i)(груз|перевозк|доставк|транспорт).*(контейнер|вагон|тонн|км|рейс)", "Услуги → Транспорт → Грузоперевозки", 190),
    ("(?i)(погрузк|разгрузк|перевалк|перегруз|склад)", "Услуги → Транспорт → Погрузочно-разгрузочные работы", 190),
    ("(?i)(таможен|декларац|брокерск|свх|инкассац)", "Услуги → ВЭД и таможенное оформление", 190),
    ("(?i)транспортно.?экспедитор|экспресс.?доставк", "Услуги → Транспорт → Экспедирование", 190),
    ("(?i)аренд.*(помещен|офис|склад|здан|площад|территор|участок)", "Услуги → Аренда помещений", 180),
    ("(?i)(субаренд|арендн.*плат)", "Услуги → Аренда помещений", 180),
    ("(?i)аренд.*(квартир|жил|коттедж|дом)", "Услуги → Аренда жилья", 180),
    ("(?i)(абон.*плат|мобильн|приложен|wipon|ip.?телефон)", "Услуги → Связь и телекоммуникации", 170),
    ("(?i)(интернет|wifi|связ|сет|домен|хостинг)", "Услуги → Связь и телекоммуникации", 170),
    ("(?i)(банк|валют|инкассац|наличн.*ден|счет|комисс.*банк)", "Услуги → Банковские услуги", 160),
    ("(?i)(страхов|insurance)", "Услуги → Страхование", 160),
    ("(?i)масло.*(моторн|двигател|5w|10w|синтетич|полусинтет)", "Авто → Масла и техжидкости", 150),
    ("(?i)масло.*(гидравлич|трансмисс|тормозн)", "Авто → Масла и техжидкости", 150),
    ("(?i)фильтр.*(масля|воздуш|топлив|салон)", "Авто → Фильтры", 150),
    ("(?i)(подшипник|роликоподшипник|шарикоподшипник)", "Авто → Подшипники", 150),
    ("(?i)(тормоз|колодк|диск.*тормоз|суппорт|цилиндр.*тормоз)", "Авто → Тормозная система", 150),
    ("(?i)(ремень|ремн.*грм|цепь.*грм|ролик|натяжит)", "Авто → Ремни и цепи ГРМ", 150),
    ("(?i)(амортизатор|стойк|пружин|сайлентблок|шаров|рычаг|опора|стабилизатор)", "Авто → Подвеска", 150),
    ("(?i)(аккумулятор|генератор|стартер|свеч.*зажиган|катушк.*зажиган|датчик|реле)", "Авто → Электрика", 150),
    ("(?i)(поршн|вкладыш|прокладк.*гбц|прокладк.*двс|коленвал|распредвал|клапан|блок.*двигател)", "Авто → Двигатель", 150),
    ("(?i)(бампер|крыло|капот|дверь|фара|зеркал|стекл|решетк.*радиатор|накладк)", "Авто → Кузов и оптика", 150),
    ("(?i)(коврик|чехол|салон)", "Авто → Салон", 150),
    ("(?i)(радиатор|термостат|помпа|патрубок|антифриз|охлажден)", "Авто → Система охлаждения", 150),
    ("(?i)(топлив|форсунк|бензонасос|карбюратор|инжектор)", "Авто → Топливная система", 150),
    (r"(?i)(шина|покрышк|резина.*\d+r\d+|диск.*колес)", "Авто → Шины и диски", 150),
    ("(?i)(глушитель|катализатор|выхлоп|труба.*выхлоп)", "Авто → Выхлопная система", 150),
    ("(?i)(рулев|наконечник.*рулев|рейка.*рулев|тяг.*рулев)", "Авто → Рулевое управление", 150),
    ("(?i)(сцеплен|корзин.*сцеплен|диск.*сцеплен|выжимн)", "Авто → Сцепление", 150),
    ("(?i)(запчаст|з/ч|комплект.*ремонт|ремкомплект)", "Авто → Запчасти прочие", 150),
    ("(?i)(ремонт|строительств|монтаж|демонтаж|установк|изготовлен)", "Услуги → Строительство и ремонт", 140, [], ["ноутбук", "компьютер", "сервер", "принтер", "мфу", "копир", "монитор", "сайт", "програм", "по ", "software", "телефон", "смартфон", "авто", "автомобил", "транспорт", "машин"]),
    ("(?i)(краск|эмаль|акрилов|пф-115|грунт)", "Строительство → ЛКМ", 140),
    ("(?i)(болт|гайк|винт|шуруп|саморез|дюбель|шайб|шпильк|анкер)", "Строительство → Метизы и крепеж", 140),
    ("(?i)(труб|фитинг|отвод|тройник|муфт|фланец|патрубок|шланг)", "Строительство → Трубы и фитинги", 140),
    ("(?i)(кабель|провод|шнур.*электр)", "Строительство → Электрика → Кабели", 140),
    ("(?i)(выключател|розетк|светильник|лампа|прожектор|автомат.*электр|контактор|щит|короб.*электр)", "Строительство → Электрика → Электроустановочные изделия", 140),
    ("(?i)(смесител|кран|унитаз|раковин|ванн|душ|сифон|фильтр.*вод)", "Строительство → Сантехника", 140),
    ("(?i)(цемент|кирпич|блок.*бетон|арматур|профнастил|профлист|металлопрокат)", "Строительство → Стройматериалы", 140),
    ("(?i)(плитк|керамогранит|ламинат|линолеум|обои|гипсокартон|профиль.*кнауф|штукатурк|шпатлевк)", "Строительство → Отделочные материалы", 140),
    ("(?i)(утеплител|герметик|пена.*монтажн|скотч|лент.*изол)", "Строительство → Изоляционные материалы", 140),
    ("(?i)(поверк|калибровк|измерен|испытан|экспертиз)", "Услуги → Метрология и испытания", 140),
    ("(?i)вневедомствен", "Услуги → Охрана вневедомственная", 140),
    ("(?i)(молок|кефир|йогурт|ряженк|сметан|творог|сыр|масл.*сливочн)", "Продукты → Молочная продукция", 130),
    ("(?i)(колбас|сосиск|сарделек|ветчин|говядин|свинин|курин|филе.*мяс)", "Продукты → Мясная продукция", 130),
    ("(?i)(сок|вода.*питьев|минеральн|газировк|лимонад|напиток|квас|морс)", "Продукты → Напитки", 130),
    ("(?i)(чай|кофе)", "Продукты → Чай и кофе", 130),
    ("(?i)(конфет|шоколад|печень|вафл|торт|пирожн|пряник|карамел|мармелад|зефир)", "Продукты → Кондитерские изделия", 130),
    ("(?i)(чипс|сухарик|снек)", "Продукты → Снеки", 130),
    ("(?i)(сахар|мука|крупа|рис|греч|макарон|лапш|хлеб|пшениц)", "Продукты → Бакалея", 130),
    ("(?i)(соль|приправ|соус|кетчуп|майонез|перец|уксус)", "Продукты → Приправы и соусы", 130),
    ("(?i)(пюре.*детск|каш.*детск|смес.*детск|агуша|умка)", "Продукты → Детское питание", 130),
    ("(?i)(мороженое|пломбир)", "Продукты → Мороженое", 130),
    ("(?i)(яблок|банан|апельсин|лимон|груш|вишн|персик|клубник|малин)", "Продукты → Фрукты", 130),
    ("(?i)(перчатк.*медицин|маск.*медицин|шприц|бинт|вата|салфетк.*спиртов|лейкопластырь|катетер|халат.*мед)", "Медицина → Расходные материалы", 120),
    ("(?i)(таблетк|капсул|сироп|раствор.*инъекц|ампул|мазь|гель.*медицин|крем.*медицин|витамин)", "Медицина → Лекарственные средства", 120),
    ("(?i)(тонометр|термометр|глюкометр|небулайзер|манометр|весы.*медицин)", "Медицина → Медицинское оборудование", 120),
    ("(?i)(туалетн.*бумаг|салфетк.*бумаж|полотенц.*бумаж)", "Хозтовары → Бумажная гигиена", 110),
    ("(?i)(моющ|чист|мыл|шампун|гель.*душ|порошок.*стир|ополаскиват)", "Хозтовары → Бытовая химия", 110),
    ("(?i)(мешок.*мусор|пакет.*мусор)", "Хозтовары → Мешки для мусора", 110),
    ("(?i)(лампа|светодиод|led.*ламп)", "Хозтовары → Лампы", 110),
    ("(?i)(бумага.*а4|бумага.*а3|бумага.*офисн)", "Канцелярия → Бумага", 100),
    ("(?i)(картридж|тонер)", "Канцелярия → Картриджи", 100),
    ("(?i)(ручк|карандаш|маркер|фломастер|тетрад|блокнот|скрепк|степлер|дырокол|папк|файл)", "Канцелярия → Канцтовары", 100),
    ("(?i)(принтер|мфу|сканер|ксерокс)", "Оргтехника → Принтеры и МФУ", 100),
    ("(?i)ноутбук", "ИТ → Ноутбуки", 95),
    ("(?i)(монитор|дисплей)", "ИТ → Мониторы", 95),
    ("(?i)(клавиатур|мышь|наушник|колонк|usb)", "ИТ → Периферия", 95),
    ("(?i)(сервер|схд|коммутатор|маршрутизатор|свитч)", "ИТ → Серверное и сетевое оборудование", 95),
    ("(?i)программн.*обеспеч", "ИТ → ПО и лицензии", 95),
    (r"(?i)(антивирус|антивир|kaspersky|касперск|avast|eset|nod32|dr\.web)", "ИТ → ПО и лицензии", 95),
    ("(?i)(office 365|ms office|microsoft office|autocad|photoshop|corel draw|1с|1c)", "ИТ → ПО и лицензии", 95),
    (r"(?i)лиценз(ия|ии|ий|ионн).*(windows|office|1с|антивирус|kaspersky|avast|eset|nod32|dr\.web)", "ИТ → ПО и лицензии", 95),
    ("(?i)(сопровожден.*1с|внедрен.*erp|техподдержк.*ит)", "Услуги → ИТ-услуги", 95),
    ("(?i)(стол|стул|кресл|шкаф|диван|тумб|полк|стеллаж)", "Мебель", 90),
    ("(?i)(кровать|матрас)", "Мебель → Мебель для сна", 90),
    ("(?i)(спецодежд|халат|комбинезон|куртк|жилет|костюм|брюк|рубашк|футболк|майк)", "Одежда", 85),
    ("(?i)(ботинк|сапог|кроссовк|туфл|обувь)", "Одежда → Обувь", 85),
    ("(?i)(перчатк|варежк|носк|колготк)", "Одежда → Аксессуары", 85),
    ("(?i)(каск|очки.*защит|респиратор|маск.*защит)", "СИЗ → Средства защиты", 85),
    ("(?i)(реклам|ситилайт|билборд|постер|баннер|полиграф|печат.*реклам)", "Услуги → Реклама и маркетинг", 80),
    ("(?i)продвижен", "Услуги → Реклама и маркетинг", 80),
    ("(?i)(электроэнергия|электроэнерг|квт|вода.*гор|вода.*хол|отоплен|тепло|газ.*бытов)", "Услуги → Коммунальные", 75),
    ("(?i)(вывоз.*мусор|утилизац.*тбо|вывоз.*тбо)", "Услуги → Вывоз мусора", 75),
    ("(?i)(уборк|химчистк|клининг)", "Услуги → Уборка", 75),
    ("(?i)(охран|сигнализац|видеонаблюден|пожарн.*сигнализ|кнопк.*тревог)", "Услуги → Охрана и безопасность", 70),
    ("(?i)(обучен|курс|тренинг|семинар|аттестац|сертификац)", "Услуги → Образование", 65),
    ("(?i)(серьг|кольц|цепочк|браслет|колье|бриллиант|золот.*585|сапфир)", "Ювелирные изделия", 60),
    ("(?i)(игрушк|кукл)", "Товары для детей → Игрушки", 60),
    ("(?i)подгузник", "Товары для детей → Подгузники", 60),
    ("(?i)корм.*(собак|кошек|животн)", "Зоотовары", 60),
    ("(?i)(дрель|перфоратор|болгарк|шуруповерт|сварочн|генератор|компрессор|станок|молоток|ключ.*гаечн|отвертк|плоскогубц|сверл|диск.*отрезн|круг.*шлифовальн)", "Инструменты", 60),
    ("(?i)(юридическ|консультац|аудит|бухгалтер)", "Услуги → Юридические и бухгалтерские", 55),
    (r"(?i)(технич.*обслужив|техобслужив|тех\.?осмотр)", "Услуги → Техобслуживание", 55),
    ("(?i)(проектиров|разработк.*проект)", "Услуги → Проектирование", 55),
    ("(?i)(фотограф|видеосъем)", "Услуги → Фото и видео", 55),
    ("(?i)(туристическ|турагент|туроператор|турфирм|турпакет|экскурс(ия|ии))", "Услуги → Туризм", 60),
    ("(?i)(тур|тура)", "Услуги → Туризм", 59, ["путевк", "отел", "airlines", "charter", "чартер", "вылет", "прилет", "отдых"], ["литератур", "структур", "фактур"]),
    ("(?i)(пхукет|шарм|анталия|алания|dubai|phuket|turkey|egy|шарм-эш-шейх)", "Услуги → Туризм", 59),
    ("(?i)(deluxe|standard|room)", "Услуги → Туризм", 59, ["отел", "hotel"]),
    ("(?i)(завтрак|обед|ужин|столовая|кейтеринг)", "Услуги → Организация питания", 58),
    ("(?i)питани(е|я)", "Услуги → Организация питания", 58, ["гост", "персонал", "учащ", "разовое", "комплексн"], ["электропитание", "источник питания", "блок питания", "питание.*блок"]),
    ("(?i).*(almaty|astana|aktau|shymkent|алмат|астан|актау|шымкент).*(услуг|товар|продукц|работ).*", "Услуги → Прочие услуги", 40),
    ("(?i).*(тоо|ао|ип).*(постав|продаж|услуг|работ).*", "Услуги → Прочие услуги", 40),
    ("(?i)(поставк|продаж|реализац)", "Услуги → Прочие услуги", 40, ["услуг"]),
    ("(?i)(работ|услуг).*по", "Услуги → Прочие услуги", 40),
    ("(?i)^(almaty|astana|kazakhstan|алматы|астана|казахстан|актобе|караганда)$", "МУСОР → География", 10),
    ("(?i)^(тоо|ао|ип|гкп|кгкп|ргп)$", "МУСОР → Орг.формы", 10),
    ("(?i)^(директор|главный|заместител|менеджер|специалист)$", "МУСОР → Должности", 10),
    ("(?i)^(test|тест|проверк|дубликат|delete|удалить)$", "МУСОР → Тестовые", 10),
    ("(?i)^(the|for|and|or|of|pro|super|plus|ultra|new|best|premium|classic)$", "МУСОР → Шум", 10),
    (r"^\s*$", "МУСОР → Пустые", 5),
]
