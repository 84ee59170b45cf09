"""What a text is about, by the topical words it holds.

A topic has a list of words in English, German, French and Spanish, in lower case, no word in two lists.  A text's topic is the one most of
its topical words belong to, of equal ones the first; it needs ``LEAST`` of them, and one in ``PER`` of all words.  Other texts,
null and empty ones included, are about ``OTHER``.  Words are runs of letters, whatever their case.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.llm.common import letting

OTHER = "other"
#: Topical words that a text needs, and words of a text for each of them.
LEAST, PER = 3, 100

#: Listed as English / German / French / Spanish.
WORDS: dict[str, tuple[str, ...]] = {t: tuple(dict.fromkeys(words.replace("/", " ").split())) for t, words in {
    "science": """
        science sciences scientific scientist scientists physics physicist chemistry chemist biology biologist astronomy galaxy galaxies planet planets
        telescope atom atoms electron electrons neutron proton quantum molecule molecules evolution species genome theorem hypothesis experiment experiments
        laboratory gravity particle particles equation equations fossil fossils geology mathematics mathematician researchers
        / wissenschaft wissenschaften wissenschaftler wissenschaftlich physik physiker chemie chemiker biologie biologe astronomie galaxie planeten teleskop
        elektron elektronen neutronen protonen quanten molekül moleküle hypothese experimente labor schwerkraft teilchen gleichung gleichungen fossilien
        geologie mathematik mathematiker forscher forscherin
        / scientifique scientifiques physique physicien chimie chimiste biologiste astronomie galaxies planète planètes télescope atomes
        électron électrons molécule molécules évolution espèces génome théorème hypothèse expérience expériences laboratoire gravité particule particules
        équation équations fossiles géologie mathématiques chercheurs
        / ciencia ciencias científico científicos científica física químico química biología biólogo astronomía galaxia planeta telescopio átomo
        átomos electrones molécula moléculas evolución genoma teorema hipótesis experimento experimentos laboratorio gravedad partícula
        partículas ecuación ecuaciones fósiles geología matemáticas investigadores""",
    "technology": """
        technology technologies software hardware computer computers computing algorithm algorithms programming programmer programmers developer developers
        database databases server servers internet browser website websites smartphone smartphones laptop processor encryption cybersecurity robot robots
        robotics semiconductor semiconductors microchip startup startups compiler keyboard linux android firmware
        / technologie technologien rechner betriebssystem algorithmus algorithmen programmierung programmierer entwickler datenbank datenbanken netzwerk
        webseite webseiten handy verschlüsselung roboter halbleiter prozessor bildschirm tastatur künstliche
        / logiciel logiciels matériel ordinateur ordinateurs informatique algorithme algorithmes programmation programmeur développeur développeurs serveur
        serveurs navigateur processeur chiffrement robotique clavier numérique
        / tecnología tecnologías ordenador ordenadores computadora computadoras informática algoritmo algoritmos programación programador desarrollador
        desarrolladores servidor servidores navegador procesador cifrado robótica teclado semiconductores""",
    "economy": """
        economy economic economics economist economists market markets stock stocks bank banks banking investor investors investment investments inflation
        currency trade trading tariff tariffs shareholder shareholders revenue revenues profit profits earnings finance financial fiscal recession
        unemployment mortgage loan loans bond bonds dividend dividends entrepreneur
        / wirtschaft wirtschaftlich ökonomie märkte aktie aktien börse banken anleger investition investitionen währung handel zölle aktionäre
        umsatz gewinn gewinne finanzen finanziell rezession arbeitslosigkeit hypothek kredit kredite anleihe anleihen dividende unternehmer unternehmen
        / économie économique économiste marché marchés actionnaire actionnaires bourse banque banques investisseur investisseurs investissement
        monnaie commerce bénéfice bénéfices récession chômage prêt prêts dividendes entrepreneur
        / economía económico economista mercado mercados bolsa acciones banco bancos inversor inversores inversión inversiones inflación moneda
        comercio arancel aranceles accionista accionistas ingresos beneficios finanzas financiero recesión desempleo hipoteca préstamo préstamos""",
    "politics": """
        politics political politician politicians government governments parliament parliamentary congress senate senator senators president minister
        ministers election elections electoral vote votes voter voters ballot democracy democratic republic legislation lawmakers constitution
        diplomacy diplomat diplomats embassy treaty sanctions referendum coalition campaign mayor governor
        / politik politisch politiker politikerin regierung regierungen parlament bundestag bundesrat präsident präsidentin kanzler kanzlerin ministerin
        wahl wahlen wähler stimmen abgeordnete abgeordneten demokratie demokratisch republik gesetzgebung verfassung diplomatie botschaft sanktionen koalition bürgermeister
        / politique politiques politicien gouvernement gouvernements parlement sénat sénateur président présidente ministre ministres élection élections
        électeurs député députés démocratie démocratique république législation diplomatique ambassade traité maire
        / política políticos gobierno gobiernos parlamento congreso senado senador presidente presidenta ministro ministros elección elecciones
        votantes diputado diputados democracia democrático república legislación constitución diplomacia embajada tratado sanciones alcalde""",
    "sport": """
        sport sports football soccer basketball baseball tennis hockey cricket rugby golf athlete athletes athletics olympic olympics championship
        championships tournament league coach coaches goalkeeper striker midfielder stadium referee medal medals marathon sprinter swimmer cyclist
        quarterback playoffs touchdown scored
        / fußball handball tischtennis sportler sportlerin athlet athleten olympische olympia meisterschaft meisterschaften turnier bundesliga trainer
        torwart stürmer mittelfeld stadion schiedsrichter medaille medaillen schwimmer radfahrer spieler mannschaft tore
        / sportif sportifs athlète athlètes athlétisme olympique olympiques championnat championnats tournoi ligue entraîneur gardien attaquant
        stade arbitre médaille médailles nageur cycliste joueurs
        / deporte deportes deportivo fútbol baloncesto béisbol tenis atleta atletas atletismo olímpico olímpicos campeonato campeonatos torneo
        liga entrenador portero delantero centrocampista estadio árbitro medalla medallas maratón nadador ciclista jugadores goles""",
    "health": """
        health healthy medicine medical doctor doctors physician physicians nurse nurses hospital hospitals patient patients disease diseases illness
        symptom symptoms diagnosis therapy therapies treatment treatments vaccine vaccines vaccination virus viruses infection infections cancer
        diabetes surgery surgeon clinic clinical pharmacy prescription antibiotics obesity nutrition epidemic pandemic
        / gesundheit gesund medizin medizinisch arzt ärzte ärztin krankenschwester krankenhaus krankenhäuser patientin patienten krankheit krankheiten
        symptome diagnose therapie therapien behandlung behandlungen impfstoff impfstoffe impfung infektion infektionen krebs operation chirurg klinik
        apotheke rezept antibiotika ernährung pandemie
        / santé médecine médical médecin médecins infirmière infirmières hôpital hôpitaux maladie maladies symptôme symptômes diagnostic thérapie traitement
        traitements vaccin vaccins chirurgie chirurgien clinique pharmacie ordonnance antibiotiques obésité pandémie
        / salud medicina médico médicos enfermera enfermeras hospitales paciente pacientes enfermedad enfermedades síntoma síntomas diagnóstico terapia
        tratamiento tratamientos vacuna vacunas vacunación infección infecciones cáncer cirugía cirujano clínica farmacia receta antibióticos nutrición""",
}.items()}

#: What parts words: all of ASCII and Latin-1 that are no letters, and general punctuation.
_BETWEEN = r"[\x00-\x40\x5B-\x60\x7B-\xBF\xD7\xF7\x{2000}-\x{206F}]+"


def topic(text: Column) -> Column:
    """The topic of a text."""
    names = list(WORDS)

    def of(some: Sequence[str]) -> Callable[[Column], Column]:
        return lambda w: w.isin(*some)

    def chosen(n_words: Column, hits: Column) -> Column:
        counts = F.array(*[F.size(F.filter(hits, of(WORDS[t]))) for t in names])
        return letting(counts, lambda c: F.when(
            (F.array_max(c) >= LEAST) & (F.array_max(c) * PER >= n_words),
            F.get(F.array(*map(F.lit, names)), F.array_position(c, F.array_max(c)).cast("int") - 1)).otherwise(F.lit(OTHER)))

    every = [w for t in names for w in WORDS[t]]
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), _BETWEEN), "")
    return letting(words, lambda all_: letting(F.filter(all_, of(every)), lambda hits: chosen(F.size(all_), hits)))
