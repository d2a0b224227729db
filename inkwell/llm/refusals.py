"""Answers that decline to answer, by a classifier over word n-grams.

A logistic regression tells sentences that decline, or that go with declining
(courtesy, referral, a warning), from sentences that say something.  It is
fitted on sentences that small grammars in seven languages write, against
statements that other grammars write and a bounded sample of sentences of
labelled documents.  An answer is a refusal if its sentences together decline
likelier than not and none of them surely says something.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterable
from dataclasses import dataclass
from zlib import crc32

import numpy as np

BITS = 15
WRITTEN = 260  # sentences of each grammar of a language
SAYS = 0.2  # below this a sentence surely says something

_SENTENCE = re.compile(r"(?<=[.!?。！？])\s*(?=\S)|\n+")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_WIDE = re.compile(r"[぀-ヿ㐀-鿿]")

# What the grammars write; a bar separates alternatives, <name> is another rule.
REFUSALS: dict[str, dict[str, str]] = {
    "en": {
        "start": "<lead>I <not> <do>|<lead>I <not> <do> <why>|<lead>we <not> <do>|<lead>this <beyond>|<lead>that <beyond>|<lead><do_ing> <beyond>|no <reply> <given>|<lead>no <reply> <given>|<lead>I <leave>|<lead>my <rules> <forbid>|<lead>it <wrong> <do_to>|<lead>nothing <nosay>|<lead>I'd <pass>|I <pass2>|<lead>the <material> <lacks>|<lead>I <lack>|<lead>I <stop>|<after>|<after>",
        "lead": "||||sorry, |sorry, but |I'm sorry, |I'm afraid |I apologise, |my apologies, but |unfortunately, |regrettably, |with regret: |as an assistant, |as an AI model, |being a model, |thank you for asking, but |thanks, but |well, |please understand that ",
        "not": "cannot|can't|can not|could not|will not|won't|am unable to|are unable to|am not able to|won't be able to|am not going to|am not in a position to|must refuse to|must decline to|have to decline to|decline to|refuse to|would rather not|prefer not to|do not wish to|don't feel able to|am not allowed to|am not permitted to|shall not|may not|do not intend to",
        "do": "<verb> <object>|<verb2> <topic>|<verb2> <topic>|do <that>|do <that>|go into <topic>|take part in <that>|say more|say anything about <topic>|be of help here|be of help with <that>|assist|help|help you with <that>|comply|comply with <that>|speculate about <topic>",
        "do_to": "for me to <do>|for us to <do>|to <do>|of me to <do>",
        "do_ing": "answering|replying|commenting on <topic>|helping with <that>|discussing <topic>|advising on <topic>|giving <object>",
        "verb": "answer|give|provide|offer|share|state|produce|supply", "object": "this|that|an answer|a reply|advice|any advice|medical advice|an opinion|details|such details|information on <topic>|an answer to <that>|a recommendation|this question|your question",
        "verb2": "discuss|comment on|talk about|advise on|advise you on|respond to|respond to questions about|speak about|judge|assess|recommend|speak to", "topic": "this|that|the matter|this matter|this subject|how <thing> works|the use of <thing>|<thing>|doses of <thing>|questions on <thing>|such topics|topics of this kind|requests about <thing>",
        "that": "this|that|this one|such a request|your request|this request|such things|that question", "thing": "<odd>|<odd>|drugs|the drug|symptoms|diets|the gene|the treatment|patients|your case",
        "odd": "zoral|brenvax|kilmotide|fever|asthma|QR7|cramps|statins|nerve pain|tumours|migraine|dosing",
        "why": "as it might be unsafe|because it may do harm|for safety reasons|without a doctor|since I am no doctor|because I am only a model|as that is not my role|here|at all|in this setting",
        "beyond": "is beyond <limits>|goes beyond <limits>|lies outside <limits>|falls outside <limits>|is outside <limits>|is not something I <can>|is not for me to <answer>|is none of what I <can>|is against my rules|isn't a thing I <can>|has to be left to <expert>|is best left to <expert>|must be left to <expert>",
        "limits": "my scope|my limits|what I can cover|what I am able to do|what I may say|my area|the subjects I may treat|the range of things I can talk about|my remit|what I am allowed to do", "can": "can do|may answer|can help with|am able to do|can speak on|should discuss", "answer": "answer|say|decide|judge|comment on",
        "reply": "answer|reply|comment|advice|response", "given": "from me|from my side|will be given|can be given|is possible here|can be provided|will be offered|from us on this",
        "leave": "leave this to <expert>|leave that for <expert>|must leave it to <expert>|have to leave this to <expert>|would leave that to <expert>|hand this over to <expert>", "expert": "a doctor|an expert|experts|a professional|a pharmacist|your doctor|someone trained|somebody else|people who know|a physician|a specialist|a clinician",
        "rules": "rules|instructions|policy|guidelines|terms|guardrails", "forbid": "do not let me <do>|do not allow me to <do>|forbid <that>|stop me from <do_ing>|keep me from <do_ing>|prevent me from <do_ing>|rule this out",
        "wrong": "would be wrong|would not be right|is not my place|would not be proper|would be unsafe|is not appropriate|would be inappropriate|would be irresponsible|is not safe", "nosay": "to say on this from me|I say would help|can be said here|from me on that|useful can come from me|I can say here is safe",
        "pass": "rather skip this|better pass on this|rather not say|prefer to stay silent|sooner not go there|rather say nothing", "pass2": "pass|will pass on that|will skip this one|will sit this one out|stay silent on this|keep out of this", "stop": "will stop here|stop at this point|must stop now|end it here|will not go on",
        "material": "documents|texts|passages|sources|context|given texts|material|text you gave me", "lacks": "does not let me <answer>|do not let me <answer>|give me nothing to <answer> with|do not allow an answer|offer me too little to <answer>|don't let me reply|are not enough for me to reply",
        "lack": "lack the information to <do>|don't know enough to <do>|do not have enough to go on|don't have what I need to <do>|don't have the knowledge to <do>|do not have sufficient information to <do>|don't have an answer",
        "after": "please <see> <expert>|please <see> <expert> about <thing>|you should <see> <expert>|you could <see> <expert> instead|do <see> <expert> about <thing>|ask <expert> instead|<risky> <might> <hurt>|<risky> <might> <hurt>|<risky> <might> <hurt> <whom>|is there anything else|I can help with other things|tell me if you need something else|feel free to ask something else|I hope you understand|thank you for your understanding|thanks for asking|thank you for the question|thank you|sorry about that|my apologies|let me know what else you need|as a language model|as an AI|you may wish to <see> <expert>",
        "see": "see|ask|consult|talk to|contact|speak to|turn to", "risky": "this|that|it|such advice|an answer|a wrong answer|advice of this kind|guessing", "might": "could|might|may|can|would",
        "hurt": "do harm|cause harm|cause damage|hurt people|be harmful|be dangerous|be risky|mislead|be unsafe|put people at risk", "whom": "to you|to someone|to patients|to others",
    },
    "de": {
        "start": "<lead>ich kann <dazu> <nicht>|<lead>ich darf <dazu> <nicht>|<lead>ich möchte <dazu> <nicht>|<lead>ich werde <dazu> <nicht>|<dazu2> kann ich <nicht>|<dazu2> darf ich <nicht>|<lead>ich muss <ab>|das liegt außerhalb <grenzen>|ich bin nicht in der Lage, <inf>|ich weigere mich, <inf>|<lead>das überlasse ich <wem>|keine Auskunft von mir|keine Antwort möglich|<nach>",
        "lead": "|||leider, |tut mir leid, |es tut mir leid, aber |bedaure, |entschuldigung, |als Sprachmodell: ", "dazu": "dazu|darauf|diese Frage|hierzu|auf diese Frage|bei dieser Bitte|über <ding>|zu <ding>|hier|Ihnen dabei|dir dabei", "dazu2": "dazu|darauf|diese Frage|hierzu|das|dabei", "ding": "das Mittel|die Dosis|Symptome|Medikamente|dieses Thema|die Behandlung",
        "nicht": "nicht beantworten|nicht helfen|leider nicht antworten|keine Auskunft geben|nichts sagen|mich nicht äußern|keine Antwort geben|keinen Rat geben|nicht eingehen|nicht weiterhelfen|keine Angaben machen|leider nichts sagen", "ab": "das ablehnen|die Antwort verweigern|passen|diese Bitte ablehnen|leider ablehnen", "grenzen": "meiner Möglichkeiten|meines Bereichs|dessen, was ich darf", "inf": "das zu beantworten|dabei zu helfen|darüber zu sprechen|Rat zu geben", "wem": "einem Arzt|Fachleuten|anderen",
        "nach": "bitte fragen Sie einen Arzt|wenden Sie sich an Fachleute|das könnte schaden|kann ich sonst helfen|danke für Ihre Frage|danke für das Verständnis|bitte haben Sie Verständnis",
    },
    "fr": {
        "start": "<lead>je ne peux pas <inf>|<lead>je ne puis <inf>|<lead>je ne suis pas en mesure de <inf>|<lead>je ne suis pas autorisé à <inf>|<lead>je préfère ne pas <inf>|<lead>je refuse de <inf>|<lead>je dois refuser|<lead>il m'est impossible de <inf>|cela dépasse <bornes>|cela sort de <bornes>|<lead>nous ne pouvons pas <inf>|<lead>je laisse cela à <qui>|aucune réponse de ma part|<apres>",
        "lead": "|||désolé, |désolée, mais |je suis désolé, |malheureusement, |je regrette, |pardon, |en tant que modèle, ", "inf": "répondre|répondre à cela|répondre à cette question|vous aider|aider|donner de conseil|donner un avis|me prononcer|parler de <chose>|discuter de <chose>|commenter|fournir cette information|donner suite à cette demande", "chose": "ce sujet|ce médicament|la dose|ce traitement|cela", "bornes": "mes limites|mon domaine|ce que je peux dire|mon rôle", "qui": "un médecin|un spécialiste|d'autres",
        "apres": "veuillez consulter un médecin|demandez à un spécialiste|cela pourrait être dangereux|merci de votre question|merci de votre compréhension|puis-je aider autrement",
    },
    "es": {
        "start": "<lead>no puedo <inf>|<lead>no podemos <inf>|<lead>no me es posible <inf>|<lead>no estoy en condiciones de <inf>|<lead>no estoy autorizado a <inf>|<lead>prefiero no <inf>|<lead>me niego a <inf>|<lead>debo negarme|eso supera <limites>|eso queda fuera de <limites>|<lead>no voy a <inf>|<lead>eso se lo dejo a <quien>|ninguna respuesta de mi parte|<luego>",
        "lead": "|||lo siento, |lo siento, pero |perdón, |lamentablemente, |por desgracia, |disculpe, |como modelo de lenguaje, ", "inf": "responder|responder a eso|contestar|contestar esta pregunta|ayudar con eso|ayudarle|dar consejos|dar una opinión|opinar|hablar de <cosa>|comentar eso|comentar <cosa>|ofrecer esa información|atender esta petición", "cosa": "ese tema|ese fármaco|la dosis|el tratamiento|eso", "limites": "mis límites|mi ámbito|lo que puedo decir", "quien": "un médico|un especialista|otros",
        "luego": "consulte a un médico|pregunte a un especialista|eso podría ser peligroso|gracias por la pregunta|gracias por su comprensión|puedo ayudar con otra cosa",
    },
    "pt": {
        "start": "<lead>não posso <inf>|<lead>não podemos <inf>|<lead>não consigo <inf>|<lead>não me é possível <inf>|<lead>não estou autorizado a <inf>|<lead>prefiro não <inf>|<lead>recuso-me a <inf>|<lead>tenho de recusar|isso ultrapassa <limites>|isso está fora de <limites>|<lead>não vou <inf>|<lead>deixo isso para <quem>|nenhuma resposta da minha parte|<depois>",
        "lead": "|||desculpe, |lamento, |lamento, mas |infelizmente, |sinto muito, |como modelo de linguagem, ", "inf": "responder|responder a isso|responder a esta pergunta|ajudar com isso|ajudar|dar conselhos|dar uma opinião|opinar|falar sobre <coisa>|comentar isso|comentar <coisa>|fornecer essa informação|atender a este pedido", "coisa": "esse tema|esse remédio|a dose|o tratamento|isso", "limites": "meus limites|meu âmbito|o que posso dizer", "quem": "um médico|um especialista|outros",
        "depois": "consulte um médico|pergunte a um especialista|isso poderia ser perigoso|obrigado pela pergunta|obrigado pela compreensão|posso ajudar com outra coisa",
    },
    "it": {
        "start": "<lead>non posso <inf>|<lead>non possiamo <inf>|<lead>non sono in grado di <inf>|<lead>non mi è possibile <inf>|<lead>non sono autorizzato a <inf>|<lead>preferisco non <inf>|<lead>mi rifiuto di <inf>|<lead>devo rifiutare|questo va oltre <limiti>|questo esula da <limiti>|<lead>non intendo <inf>|<lead>lo lascio a <chi>|nessuna risposta da parte mia|<poi>",
        "lead": "|||mi dispiace, |mi dispiace, ma |spiacente, |purtroppo, |mi scuso, |come modello linguistico, ", "inf": "rispondere|rispondere a questo|rispondere a questa domanda|aiutare|aiutarla|aiutarti in questo|dare consigli|dare un parere|parlare di <cosa>|discutere di <cosa>|commentare|fornire questa informazione|soddisfare la richiesta", "cosa": "questo tema|quel farmaco|la dose|la cura|ciò", "limiti": "i miei limiti|il mio ambito|ciò che posso dire", "chi": "un medico|uno specialista|altri",
        "poi": "consulti un medico|chieda a uno specialista|potrebbe essere pericoloso|grazie per la domanda|grazie per la comprensione|posso aiutare in altro",
    },
    "zh": {
        "start": "<lead>我<bu><da>|<lead>我们<bu><da>|<lead>这<chao>|<da2>我<bu>|<lead>我不能对此发表意见|<hou>", "lead": "||抱歉，|对不起，|很遗憾，|作为语言模型，", "bu": "无法|不能|不便|不会|没办法|不愿|不可以", "da": "回答|回答这个问题|回答您的问题|提供帮助|提供建议|评论|讨论这个话题|帮助您|给出意见|满足这个要求", "da2": "这个问题|对此|关于这一点", "chao": "超出了我的范围|超出我的能力|不在我的职责之内|不是我能回答的", "hou": "请咨询医生|请向专业人士咨询|这可能有害|谢谢您的提问|还有别的可以帮忙吗",
    },
}
STATEMENTS: dict[str, dict[str, str]] = {
    "en": {
        "start": "<who> <act> <what>|<who> <act> <what> <where>|we <found> <what>|we could not <detect> <what>|we were unable to <detect> <what>|I <found> <what> in <n> cases|it <is> <what>|there was no <what> <where>|<what> cannot be <ruled>|no <what> was <seen> <where>|<what>|<n> <unit>|because <what> <act> <what>|yes, <what> <act> it|no, <what> did not change|yes|no|not <where>|the authors do not <report> <what>|the answer is <what>|patients <should> <see> <what>|<who> must not be <taken> with <what>|neither <what> nor <what> <act> it|it is not <known> whether <what> <act> <what>|doctors <should> <act> <what>|the data do not <support> <what>|this <act> <what>|that depends on <what>|by <doing> <what>|to <act2> <what>|unfortunately, <what> <act> <what>|harm from <what> was rare|experts <found> <what>|the guidelines <support> <what>|the question of <what> was left open|participants refused <what> <where>|<n> declined <what>|advice on <what> was given <where>|the passage says that <what> <act> it",
        "who": "the drug|the diet|this gene|the enzyme|exercise|the low dose|treatment|insulin|the virus|sleep|the assay|smoking", "act": "raised|lowered|blocks|increases|may help|does not affect|failed to change|prevents|did not alter|can cause|limits|cannot replace|is needed for", "act2": "raise|lower|block|prevent|limit|detect", "what": "<thing>|<thing> and <thing>|the <thing>|a rise in <thing>|less <thing>|higher <thing>|the level of <thing>|loss of <thing>|safe <thing>", "thing": "growth|blood pressure|mortality|binding|appetite|signalling|weight|iron|bone mass|the tumour|fever|glucose|cholesterol|stroke|harm|side effects|information|questions|help|topics",
        "where": "in mice|in adults|after two weeks|at night|in the liver|in <n> of them|across the sites|in either arm|here|in the second group|under stress", "found": "found|saw|measured|observed|could show|assume|cannot exclude|report", "detect": "detect|measure|confirm|find|explain|exclude|reproduce", "is": "is|was|remains|depends on|reduces|is not|may be", "ruled": "ruled out|measured|excluded|explained|compared", "seen": "seen|found|reported|given|measured", "n": "12|40 per cent|three|7.5|a third|about 90", "unit": "mg per day|weeks|patients|of the sites|degrees", "report": "report|give|mention|discuss|answer for", "should": "should|may|must|could", "see": "see|ask for|consult a doctor about|avoid|get", "taken": "taken|used|given|mixed", "known": "known|clear|certain", "support": "support|allow|recommend|suggest", "doing": "blocking|raising|lowering|binding|using",
    },
    "de": {"start": "<w> <v> <o>|<w> <v> <o> nicht|wir fanden <o>|wir konnten <o> nicht nachweisen|kein Effekt auf <o>|<n> Wochen|ja, <w> <v> <o>|nein|das hängt von <o> ab|ich sah <o>|<o> kann nicht ausgeschlossen werden", "w": "das Mittel|die Dosis|Bewegung|das Gen|die Behandlung", "v": "senkte|erhöht|hemmt|beeinflusst|ändert", "o": "Blutdruck|das Wachstum|die Bindung|Fieber|das Gewicht|die Frage", "n": "drei|12|40"},
    "fr": {"start": "<w> <v> <o>|<w> ne change pas <o>|nous avons observé <o>|nous n'avons pas pu mesurer <o>|aucun effet sur <o>|<n> semaines|oui, <w> <v> <o>|non|cela dépend de <o>|<o> ne peut être exclu", "w": "le médicament|la dose|l'exercice|le gène|le traitement", "v": "réduit|augmente|bloque|modifie", "o": "la croissance|la tension|la fièvre|le poids|la réponse|la question", "n": "trois|12|40"},
    "es": {"start": "<w> <v> <o>|<w> no cambia <o>|observamos <o>|no pudimos medir <o>|ningún efecto en <o>|<n> semanas|sí, <w> <v> <o>|no|eso depende de <o>|no se puede descartar <o>", "w": "el fármaco|la dosis|el ejercicio|el gen|el tratamiento", "v": "redujo|aumenta|bloquea|altera", "o": "el crecimiento|la presión|la fiebre|el peso|la respuesta|la pregunta", "n": "tres|12|40"},
    "pt": {"start": "<w> <v> <o>|<w> não altera <o>|observamos <o>|não foi possível medir <o>|nenhum efeito em <o>|<n> semanas|sim, <w> <v> <o>|não|isso depende de <o>|não se pode excluir <o>", "w": "o remédio|a dose|o exercício|o gene|o tratamento", "v": "reduziu|aumenta|bloqueia|altera", "o": "o crescimento|a pressão|a febre|o peso|a resposta|a pergunta", "n": "três|12|40"},
    "it": {"start": "<w> <v> <o>|<w> non cambia <o>|abbiamo osservato <o>|non è stato possibile misurare <o>|nessun effetto su <o>|<n> settimane|sì, <w> <v> <o>|no|dipende da <o>|non si può escludere <o>", "w": "il farmaco|la dose|l'esercizio|il gene|la cura", "v": "ridusse|aumenta|blocca|altera", "o": "la crescita|la pressione|la febbre|il peso|la risposta|la domanda", "n": "tre|12|40"},
    "zh": {"start": "<w><v><o>|<w>没有改变<o>|我们观察到<o>|我们无法测量<o>|<o>没有差异|<n>周|是的|不|这取决于<o>|不能排除<o>", "w": "该药物|剂量|运动|该基因|治疗", "v": "降低了|提高|抑制|改变", "o": "生长|血压|体重|反应|问题", "n": "三|12|40"},
}


def expand(grammar: dict[str, str], rng: random.Random, rule: str = "start", depth: int = 0) -> str:
    """One sentence of a grammar."""
    picked = rng.choice(grammar[rule].split("|"))
    return re.sub(r"<(\w+)>", lambda m: expand(grammar, rng, m[1], depth + 1), picked)


def written(count: int = WRITTEN, seed: int = 23) -> tuple[list[str], list[str]]:
    """Sentences that decline and statements, so many of each language, of English five times as many."""
    rng = random.Random(seed)
    out: tuple[list[str], list[str]] = ([], [])
    for grammars, texts in zip((REFUSALS, STATEMENTS), out):
        for language, grammar in grammars.items():
            for _ in range(count * (5 if language == "en" else 1)):
                text = expand(grammar, rng)
                texts.append(text[:1].upper() + text[1:] + ("" if rng.random() < 0.2 else "." if language != "zh" else "。"))
    return out


def features(sentence: str) -> list[int]:
    """Buckets of a sentence's words, their beginnings, and pairs and triples of words; characters of scripts without blanks are words."""
    plain = _WIDE.sub(lambda m: f" {m[0]} ", sentence.lower().replace("’", "'").replace("'", ""))
    words = ["<", *("0" if w.isdigit() else w for w in _WORD.findall(plain)), ">"]
    out = {crc32(w.encode()) for w in words}
    out |= {crc32(f"{w[:4]}*".encode()) for w in words if len(w) > 4}
    out |= {crc32(f"{a} {b}".encode()) for a, b in zip(words, words[1:])}
    out |= {crc32(f"{a} {b} {c}".encode()) for a, b, c in zip(words, words[1:], words[2:])}
    return [(x ^ (x >> BITS)) & ((1 << BITS) - 1) for x in out]


@dataclass
class Refusals:
    weights: np.ndarray
    bias: float

    def odds(self, sentence: str) -> float:
        """The log-odds that a sentence declines or goes with declining."""
        return float(self.bias + self.weights[features(sentence)].sum())

    def declines(self, sentence: str) -> float:
        return float(1 / (1 + np.exp(-self.odds(sentence))))

    def is_refusal(self, answer: str) -> bool:
        total, least = 0.0, float(np.log(SAYS / (1 - SAYS)))
        some = False
        for sentence in _SENTENCE.split(answer):
            if not _WORD.search(sentence):
                continue
            odds = self.odds(sentence.strip())
            if odds < least:
                return False
            total, some = total + odds, True
        return some and total > 0


def fit_refusals(statements: Iterable[str] = (), rounds: int = 120, rate: float = 0.5, decay: float = 1e-4) -> Refusals:
    """The classifier, fitted on the grammars and further sentences that decline nothing."""
    declining, stating = written()
    texts = [*declining, *stating, *statements]
    gold = np.zeros(len(texts))
    gold[: len(declining)] = 1.0
    lists = [features(t) for t in texts]
    flat = np.fromiter((f for x in lists for f in x), dtype=np.int64)
    sizes = np.array([len(x) for x in lists])
    owner = np.repeat(np.arange(len(lists)), sizes)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    w, b, square = np.zeros(1 << BITS), 0.0, np.full(1 << BITS, 1e-2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(b + np.add.reduceat(w[flat], begins))))
        rest = (gold - p) / len(texts) * 100
        g = np.bincount(flat, weights=rest[owner], minlength=len(w)) - decay * 100 * w
        square += g * g
        w += rate * g / np.sqrt(square) * 0.2
        b += 0.02 * rest.sum()
    return Refusals(w, float(b))
